import hashlib
import re

import numpy as np
from helpers import SF, docs, empty, hard_rows

from vitrine.llm.decontamination import FMIndex, decontamination, drop_contaminated, find_spans, suffix_array

ITEMS = "item_id bigint, text string, label string, n_words int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + k]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in texts:
        w, hit, own = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if found := windows.get(tuple(w[a : a + k])):
                    hit |= set(range(a, a + k))
                    own |= found
        out.append((doc, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def check(spark, frame, bench, **options):
    got = sorted((tuple(r) for r in decontamination(frame, bench).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in frame.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    return got


def test_the_tables(spark):
    got = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert any(r[-1] for r in got)


def test_planted_places(spark):
    item = "a b c d e f g h i j k l m n o p"
    bench = spark.createDataFrame([(10, item, "", 0), (9, "Short Item", "", 0), (None, "x y", "", 0), (3, None, "", 0), (4, " .,! ", "", 0), (11, item, "", 0), (10, item, "", 0)], ITEMS)
    frame = docs(spark, [f"zero {item.upper()}!", item[:-2], f"{item} {item}", "short, item", "short short item short", "b c d e f g h i j k l m n", "a b c d e f g h i j k l", f"{item} " + "far " * 400, "x y", ""])
    got = check(spark, frame, bench)
    assert sum(r[-1] for r in got) == 7
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {6, 7, 9}
    one = [r.asDict(True) for r in find_spans(frame, bench, ["doc_id"], block_bytes=16).where("kept.doc_id = 2").collect()]
    assert one[0]["spans"] == [{"start": 0, "end": 32}] and one[0]["items"] == ["10", "11"]


def test_hard_rows(spark):
    bench = spark.createDataFrame([(1, "one text", "", 0), (2, "mit vielen Worten", "", 0)], ITEMS)
    check(spark, hard_rows(spark), bench)
    check(spark, hard_rows(spark), spark.createDataFrame([], ITEMS))
    assert decontamination(empty(spark), bench).count() == 0


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(0)
    text = np.concatenate([rng.integers(1, 4, 500), np.tile([1, 2, 3, 3], 60), [0]])
    assert [tuple(text[i:]) for i in suffix_array(text)] == sorted(tuple(text[i:]) for i in range(len(text)))
    index = FMIndex(text)
    for size in (1, 3, 6):
        codes = rng.integers(1, 5, (40, size))
        want = {p: [i for i in range(len(text) - size + 1) if (text[i : i + size] == codes[p]).all()] for p in range(40)}
        phrase, low, high = index.search(codes, np.full(40, size))
        got = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(phrase, low, high, strict=True)}
        assert got == {p: w for p, w in want.items() if w}
