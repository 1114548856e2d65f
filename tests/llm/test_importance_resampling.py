import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from helpers import SF, docs, empty, hard_rows

from vitrine.llm.importance_resampling import Features, Gains, bitplanes, bucket_counts, gains, resampled, weighted
from vitrine.llm.queries import ORACLES


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(documents, benchmark, buckets=10_000):
    """The contract in plain Python."""
    code = lambda t: Counter(zlib.crc32(w.encode()) % buckets for w in words_of(t))
    s, t = sum((code(x) for _, x in documents), Counter()), sum((code(x) for x in benchmark), Counter())
    big_s, big_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in s}
    rows = []
    for d, x in documents:
        weight = sum(gain[b] * n for b, n in code(x).items())
        h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
        score = None if d is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(words_of(x)), weight, score, None])
    fit = sorted((r for r in rows if r[1] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(fit[: 10 * len(fit) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def texts(frame, key):
    return [(r[key], r["text"]) for r in frame.collect()]


def test_table_against_brute_force(spark):
    documents, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute(texts(documents, "doc_id"), [x for _, x in texts(benchmark, "item_id")])
    assert sorted(map(tuple, resampled(documents, benchmark).collect()), key=str) == want
    drawn = [r for r in want if r[4]]
    assert len(drawn) == 10 * sum(r[1] >= 20 for r in want) // 100 > 0


def test_hard_rows_and_the_sql(spark):
    rows = texts(hard_rows(spark), "doc_id") + [(100 + i % 40, "word " * (18 + i % 5) + "x" * i) for i in range(90)] + [(7, "wörter ÄÖ 0 1 " * 9)]
    bench = [None, "", "word wörter one", "emoji 😀 word"]
    documents = spark.createDataFrame([(d, t, "w", 3) for d, t in rows], "doc_id bigint, text string, weight string, n_words int")
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id bigint, text string")
    want = brute(rows, bench)
    assert sorted(map(tuple, resampled(documents, benchmark).collect()), key=str) == want
    db = duckdb.connect()
    for name, key, own in (("documents", "doc_id", rows), ("benchmark", "item_id", list(enumerate(bench)))):
        db.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", own)
    assert sorted(db.execute(ORACLES["op12_importance_resampling"]).fetchall(), key=str) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert resampled(empty(spark), none).count() == 0
    got = resampled(docs(spark, ["one two three", None]), none).collect()
    assert sorted(map(tuple, got), key=str) == brute([(0, "one two three"), (1, None)], [])


def test_bit_planes_give_exact_sums():
    rng = np.random.default_rng(4)
    for size in (1, 63, 64, 65, 1000):
        values = rng.integers(-9000, 9000, size)
        lists = [rng.integers(0, size, n).tolist() for n in (0, 1, 5, 3000, 0, 40)] + [[size - 1] * 70_000]
        assert Gains(values).weights(lists).tolist() == [int(values[x].sum()) for x in lists]
    assert Gains(np.zeros(5, dtype=np.int64)).weights([[1, 2], []]).tolist() == [0, 0]
    planes = bitplanes(np.array([5, 0, 7]))
    assert [int(p[0]) for p in planes] == [0b101, 0b100, 0b101]


def test_longer_features_and_other_buckets(spark):
    frame, target = docs(spark, ["a b a b", "b a", None]), docs(spark, ["a b"])
    assert bucket_counts(frame, 2, 97).sum() == 7 + 3
    got = weighted(frame, target, ["doc_id"], 2, 97).orderBy("kept.doc_id").collect()
    features = Features(2, 97)
    gain = gains(bucket_counts(frame, 2, 97), bucket_counts(target, 2, 97))
    for r, t in zip(got, [b"a b a b", b"b a", None], strict=True):
        n, own = features(t)
        assert (r["n_words"], r["n_features"], r["weight"]) == (n, len(own), int(gain[own].sum()) if own else 0)
