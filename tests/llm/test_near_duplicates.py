import random
from collections import Counter

import numpy as np
from helpers import SF, docs, empty, hard_rows
from pyspark.sql import functions as F

from vitrine.llm import near_duplicates
from vitrine.llm.common import stage
from vitrine.llm.near_duplicates import Layout, _distance, _segments, ball_meets, ball_pairs, block_links, grouped, keep_one, layout, leader_pairs, nodes, shingles, verified, wide_fingerprint
from vitrine.session import _written

WORDS = [f"w{i}" for i in range(4000)]


def sets(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [w] if x > share else [rng.choice(WORDS)] if x > share / 2 else []
    return out


def test_recall_and_clean_documents(spark):
    """Pairs of similarity 0.8 to 1 are found, pairs under it are not."""
    rng = random.Random(6)
    texts = []
    for _ in range(300):
        words = [rng.choice(WORDS) for _ in range(rng.randint(60, 500))]
        texts += [" ".join(words), " ".join(changed(rng, words, rng.uniform(0, 0.06)))]
    own = [sets(t) for t in texts]
    near = {i for i in range(0, len(texts), 2) if jaccard(own[i], own[i + 1]) >= 0.8}
    hard = {i for i in near if jaccard(own[i], own[i + 1]) < 0.85}
    got = {r["doc_id"]: r["root"] for r in grouped(docs(spark, texts)).collect()}
    met = {i for i in range(0, len(texts), 2) if got[i] == got[i + 1]}
    assert len(near) > 120 and len(hard) > 15 and met <= near
    assert len(met) >= 0.95 * len(near) and len(met & hard) >= 0.8 * len(hard)
    assert len(set(got.values())) == len(texts) - len(met)
    kept = {r["doc_id"] for r in keep_one(docs(spark, texts)).collect()}
    assert kept == set(range(len(texts))) - {i + 1 for i in met}


def test_table_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    own = {r["doc_id"]: sets(r["text"]) for r in table.collect()}
    ids = sorted(own)
    name = {d: d for d in ids}

    def root(d):
        while name[d] != d:
            d = name[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 5 * min(len(own[a]), len(own[b])) >= 4 * max(len(own[a]), len(own[b])) and jaccard(own[a], own[b]) >= 0.8:
                x, y = sorted((root(a), root(b)))
                name[y] = x
    want = {root(d) for d in ids}
    got = {r["doc_id"] for r in keep_one(table).collect()}
    assert want <= got and len(got) <= len(want) + 0.1 * (len(ids) - len(want))


def test_hard_rows_keep_every_text(spark):
    table = hard_rows(spark).withColumn("more", F.create_map(F.lit("a"), "text"))
    kept = keep_one(table)
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert kept.columns == table.columns and len(rows) == len(set(rows))
    texts = {t for _, t in rows}
    assert {"one text", "another text", "plain words here and there", "no id at all"} <= texts and rows.count((4, "plain words here and there")) == 1
    assert [r for r in rows if not sets(r[1])] == [(1, None)]  # the wordless texts are one group
    assert keep_one(empty(spark)).count() == 0


def test_large_groups_stay_linear(spark):
    rng = random.Random(1)
    words = [rng.choice(WORDS) for _ in range(200)]
    texts = [" ".join([*words[:i % 190], f"n{i}", *words[i % 190:]]) for i in range(600)] + [" ".join(rng.choice(WORDS) for _ in range(100)) for _ in range(50)]
    got = {r["doc_id"]: r["root"] for r in grouped(docs(spark, texts)).collect()}
    assert len({got[i] for i in range(600)}) == 1 and len(set(got.values())) == 51


def test_every_pair_within_a_segment_ball_is_fetched_once(spark):
    rng = random.Random(2)
    plan = Layout(4, 20, 2, 128, 64)
    values = [rng.getrandbits(80) for _ in range(40)]
    for v in list(values):
        for _ in range(3):
            for bit in rng.sample(range(80), rng.choice([1, 2, 8])):
                v ^= 1 << bit
            values.append(v)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(i + 1, [signed(v & (2**64 - 1)), signed(v >> 64)]) for i, v in enumerate(values)], "node bigint, fp array<bigint>")
    parts = lambda v: [v >> (20 * k) & 0xFFFFF for k in range(4)]
    shown = frame.selectExpr("node", f"{_segments(plan)} as s").collect()
    assert all([x & 0xFFFFF for x in r["s"]] == parts(values[r["node"] - 1]) for r in shown)
    near = {(i + 1, j + 1) for i in range(len(values)) for j in range(i + 1, len(values)) if any((a ^ b).bit_count() <= 1 for a, b in zip(parts(values[i]), parts(values[j]), strict=True))}
    got = ball_pairs(frame, plan).collect()
    assert {tuple(r) for r in got} == near and len(got) == len(near) > 100
    equal = {(r["a"], r["b"]) for r in leader_pairs(frame, plan).collect()}
    assert equal and max(Counter(a for a, _ in equal).values()) <= 3 and all(b < a and any(x == y for x, y in zip(parts(values[a - 1]), parts(values[b - 1]), strict=True)) for a, b in equal)
    far = frame.selectExpr(f"{_distance('fp', 'array(0L, 0L)')} as d", "node").collect()
    assert all(r["d"] == values[r["node"] - 1].bit_count() for r in far)


def test_layout_grows_with_the_table():
    small, large = layout(10), layout(10**9)
    assert small.bits == 16 and large.bits == 32 and large.segments > small.segments and 64 * large.words >= large.segments * large.bits


def test_fingerprint_is_the_majority():
    memo = {}
    hashes = shingles(b"One two three four five six SEVEN", memo)
    assert len(hashes) == 3 and (hashes == shingles(b"one two  three four five six seven", memo)).all()
    assert len(shingles(b"a b", memo)) == 1 and len(shingles(b" ", memo)) == 0
    one = wide_fingerprint(hashes[:1], 3)
    assert (wide_fingerprint(np.repeat(hashes[:1], 3), 3) == one).all() and (wide_fingerprint(hashes[:0], 3) == 0).all()


def test_links_between_settled_groups_are_kept(spark):
    """A chain of sliding windows is one group, though its ends are far apart and most of its nodes find a leader early."""
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        words = [f"{rng.choice(WORDS)}{i}" for i in range(700)]
        texts += [" ".join(words[k : k + 104]) for k in range(0, 590, 5)]
    got = {r["doc_id"]: r["root"] for r in grouped(docs(spark, texts)).collect()}
    assert len(set(got.values())) == 6


def test_pairs_of_different_roots_are_fetched_from_their_members(spark):
    plan = Layout(1, 16, 1, 64, 64)
    rows = [(1, 0, 1, False), (2, 0, 1, False), (3, 1, 3, False), (4, 0x8000, 3, False), (5, 0x8001, 5, True), (6, 0xFF, 6, True)]
    frame = spark.createDataFrame([(n, [f], r, a) for n, f, r, a in rows], "node bigint, fp array<bigint>, root bigint, alone boolean")
    got = [tuple(r) for r in ball_pairs(frame, plan).collect()]
    assert sorted(got) == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 5), (4, 5)]


def test_intermediate_tables_are_gone_when_groups_are_known(spark):
    rng = random.Random(9)
    texts = [" ".join([*[f"{rng.choice(WORDS)}"] * 3, *[rng.choice(WORDS) for _ in range(80)]]) for _ in range(30)]
    texts += [t + " more" for t in texts]
    since = len(_written)
    got = {r["doc_id"]: r["root"] for r in grouped(docs(spark, texts)).collect()}
    assert len(_written) == since + 1 and len(set(got.values())) == 30
    assert len({r["doc_id"] for r in keep_one(docs(spark, texts)).collect()}) == 30 and len(_written) == since + 2


def test_crowds_and_groups_are_met_by_a_row_a_node(spark):
    """Of 200 single nodes with one segment value and a group of 200 no pair becomes a row, where ``ball_pairs`` has 59,900."""
    plan = Layout(1, 16, 1, 64, 64)
    rows = [(n, [5], n if n <= 200 else 201, n <= 200) for n in range(1, 401)]
    frame = spark.createDataFrame(rows, "node bigint, fp array<bigint>, root bigint, alone boolean")
    meets = ball_meets(frame, plan)
    assert [x.count() for x in meets] == [0, 200, 200, 200]
    assert ball_pairs(frame, plan).count() == 200 * 199 // 2 + 200 * 200


def test_links_in_crowds_are_found(spark, monkeypatch):
    """Variants of one text that are mostly too far apart to be linked."""
    monkeypatch.setattr(near_duplicates, "CROWD", 8)
    rng = random.Random(12)

    def variants(n):
        base = [rng.choice(WORDS) for _ in range(150)]
        texts = []
        for _ in range(n):
            words = list(base)
            for k in rng.sample(range(150), rng.randint(1, 8)):
                words[k] = f"x{rng.random()}"
            texts.append(" ".join(words))
        return texts

    for n in (150,):
        texts = variants(n)
        plan = layout(n)
        table = nodes(docs(spark, texts), plan).selectExpr("*", "node as root", "true as alone")
        meets = ball_meets(stage(table, "test-nodes"), plan, 0.8)
        links = {tuple(sorted(p)) for p in block_links(docs(spark, texts), table, meets, plan, 0.8, 5).collect()}
        assert len(links) > n / 3
        links |= {tuple(sorted(p)) for p in verified(docs(spark, texts), table, meets.pairs, plan, 0.8, 5).collect()}
        own = {r["node"]: sets(texts[r["doc_id"]]) for r in table.collect()}
        near = {(a, b) for a in own for b in own if a < b and jaccard(own[a], own[b]) >= 0.8}
        assert links <= near and len(links) >= 0.9 * len(near)


def test_links_in_blocks_are_those_of_pairs(spark):
    """Blocks give what the pairs of ``ball_pairs`` give when all are verified, but for further links to one root."""
    rng = random.Random(13)
    base = [rng.choice(WORDS) for _ in range(120)]
    texts = []
    for i in range(200):
        words = list(base)
        for k in rng.sample(range(120), rng.randint(1, 6)):
            words[k] = f"y{rng.random()}"
        texts.append(" ".join(words))
    plan = layout(200)
    table = nodes(docs(spark, texts), plan)
    group = [r["node"] for r in table.orderBy("node").limit(60).collect()]
    rooted = stage(table.withColumn("alone", ~F.col("node").isin(group)).withColumn("root", F.when(F.col("alone"), F.col("node")).otherwise(F.lit(group[0]))), "test-rooted")
    whole = {(r["a"], r["b"]) for r in verified(docs(spark, texts), rooted, ball_pairs(rooted, plan, 0.8), plan, 0.8, 5).collect()}
    meets = ball_meets(rooted, plan, 0.8)
    found = {tuple(sorted(p)) for p in block_links(docs(spark, texts), rooted, meets, plan, 0.8, 5).collect()}
    found |= {tuple(sorted(p)) for p in verified(docs(spark, texts), rooted, meets.pairs, plan, 0.8, 5).collect()}
    root = {r["node"]: r["root"] for r in rooted.collect()}
    ends = lambda pairs: {tuple(sorted((root[a], root[b]))) for a, b in pairs}
    assert found <= {tuple(sorted(p)) for p in whole} and ends(found) == ends(whole)
    assert any(root[a] == group[0] for a, b in whole) and len(ends(whole)) > 30
