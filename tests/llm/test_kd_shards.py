import zlib
from collections import defaultdict

from helpers import SF, docs, empty, hard_rows

from vitrine.llm.kd_shards import LAW, shards


def check(frame, count=16):
    """Sizes, CRCs and slots are right; returns bytes per shard and shards per text."""
    texts = defaultdict(set)
    for r in frame.collect():
        texts[r["doc_id"]].add(r["text"] or "")
    got = shards(frame, count).collect()
    assert len(got) == frame.count()
    weight, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        text = next(t for t in texts[r["doc_id"]] if zlib.crc32(t.encode()) == r["text_crc32"])
        assert r["size"] == len(text.encode()) + 1 and r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < count
        weight[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        places[text].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return weight, places


def test_bytes_are_near_equal_and_equal_texts_together(spark):
    frame = docs(spark, [f"text number {i % 4500} " + "w" * (i % 4500 % 37) for i in range(9000)])
    weight, places = check(frame)
    mean = sum(weight.values()) / 16
    assert len(weight) == 16 and max(weight.values()) < 1.02 * mean and min(weight.values()) > 0.98 * mean
    assert all(len(p) == 1 for p in places.values())
    weight, _ = check(frame, 5)
    assert max(weight.values()) < 1.02 * sum(weight.values()) / 5


def test_a_heavy_group_is_spread(spark):
    weight, places = check(docs(spark, ["the same text in a third of all rows"] * 1000 + [f"another text with number {i:05d}...." for i in range(2000)]))
    mean = sum(weight.values()) / 16
    assert max(weight.values()) < 1.03 * mean and min(weight.values()) > 0.97 * mean
    assert sum(len(p) > 1 for p in places.values()) == 1


def test_table_and_hard_rows(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))
    check(hard_rows(spark))
    check(docs(spark, ["one"]))
    assert shards(empty(spark)).count() == 0


def test_every_node_is_cut_at_the_weighted_median_of_its_widest_dimension(spark):
    """The tree, read off the shards: brute force over all nodes."""
    for frame, count in ((spark.read.parquet(f"{SF}/documents.parquet"), 16), (docs(spark, [f"{'ü' * (i % 90)}{'x' * (i * i % 700)} {i}" for i in range(3000)]), 11)):
        texts = {r["doc_id"]: r["text"] or "" for r in frame.collect()}
        rows = []
        for r in shards(frame, count).collect():
            t = texts[r["doc_id"]]
            rows.append((r["shard"], r["size"], (len(t), len(t.encode()) - len(t), zlib.crc32(t.encode()))))
            assert r["law"] == LAW
        spans = [max(1, max(r[2][d] for r in rows) - min(r[2][d] for r in rows)) for d in range(3)]
        target = sum(r[1] for r in rows) / count
        open_ones, cuts = [(0, count)], 0
        while open_ones:
            low, leaves = open_ones.pop()
            own = [r for r in rows if low <= r[0] < low + leaves]
            if leaves == 1:
                continue
            extents = [(max(r[2][d] for r in own) - min(r[2][d] for r in own)) / spans[d] for d in range(3)]
            dim, half = extents.index(max(extents)), leaves // 2
            left, right = [r for r in own if r[0] < low + half], [r for r in own if r[0] >= low + half]
            assert max(r[2][dim] for r in left) <= min(r[2][dim] for r in right)
            goal = sum(r[1] for r in own) * half / leaves
            at_border = max(r[1] for r in own if r[2][dim] in (max(x[2][dim] for x in left), min(x[2][dim] for x in right)))
            assert abs(sum(r[1] for r in left) - goal) <= at_border + target / 1000
            open_ones += [(low, half), (low + half, leaves - half)]
            cuts += 1
        assert cuts == count - 1
