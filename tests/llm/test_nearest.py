import numpy as np
from helpers import SF

from vitrine.llm.nearest import Shard, nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, neighbours=20, every=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % every == 0:
            scores = (x * q).sum(axis=1)
            order = [k for k in np.lexsort((ids, -scores)) if ids[k] != i][:neighbours]
            out[int(i)] = [(int(ids[k]), scores[k]) for k in order]
    return out


def found(spark, rows, **options):
    out = {}
    for r in nearest(frame(spark, rows), **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall_of_the_forest(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((10, 32))
    x = centres[rng.integers(0, 10, 6000)] + 1.2 * rng.standard_normal((6000, 32))
    x *= rng.uniform(0.5, 2, 6000)[:, None]  # norms differ, so nearness isn't the angle
    rows = list(enumerate(x.astype(np.float32).tolist()))
    want = brute(rows)
    got = found(spark, rows, shard_rows=2000, least=200, wave=100)
    assert set(got) == set(want)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    scores = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(scores.get((q, i), s) - s) < 1e-9 for q in got for i, s in got[q])


def test_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, want = found(spark, rows), brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_hot_vector_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(1500)] + [(i, rng.standard_normal(4).tolist()) for i in range(1500, 3000)]
    got, want = found(spark, rows, least=100), brute(rows)
    for q in range(0, 1500, 20):
        assert [i for i, s in got[q] if s == 1.0] == [i for i, s in want[q] if s == 1.0]


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]),
        (None, [1.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 0.0, 0.0]), (140, [0.0, 1.0, 0.0]), (160, [2.0, 2.0]), (160, [5.0, 5.0]),
    ]
    got = {}
    for r in nearest(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    # two vectors under id 160: each a candidate for the other, each with ranks of its own
    assert {q: sorted(v) for q, v in got.items()} == {
        0: [(1, 160, 15.0), (2, 160, 6.0), (3, 1, 5.0)], 140: [(1, 2, 0.0)],
        160: [(1, 1, 20.0), (1, 160, 20.0), (2, 1, 8.0), (2, 160, 20.0), (3, 0, 6.0), (3, 0, 15.0)],
    }
    assert found(spark, []) == {}


def test_small_shards_ascend_to_the_root():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 16))
    shard = Shard(np.arange(300), np.arange(300), x, 20, 128, 16, 0.5, 1024)
    every = [np.sort(c).tolist() for c in shard.forest.candidates(x[:5], shard.enough)]
    assert every == [list(range(300))] * 5
    few = [len(c) for c in shard.forest.candidates(x[:5], 150)]
    assert all(0 < n < 300 for n in few)
