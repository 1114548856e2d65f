import random
import time

import duckdb
from helpers import SF, docs, empty, hard_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.llm.periodic_runs import LEAST, PERIODS, collapsed, digests, periodic_runs, runs_of, spiked, with_runs
from vitrine.llm.queries import ORACLES


def brute(words):
    """Every lag's stretches of equal words, those with a smaller period left out."""
    n, found = len(words), []
    for q in range(1, n // PERIODS + 1):
        i = q
        while i < n:
            if words[i] == words[i - q]:
                e = i
                while e < n and words[e] == words[e - q]:
                    e += 1
                if e - i + q >= max(LEAST, PERIODS * q) and not any(p < q and a <= i - q and a + k >= e for a, k, p in found):
                    found.append((i - q, e - i + q, q))
                i = e
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def check(texts):
    texts = [[w if isinstance(w, bytes) else str(w).encode() for w in t] for t in texts]
    assert runs_of(texts) == [brute(t) for t in texts]


def test_handmade():
    aab = list("aab")
    check([["a"] * 23, ["a"] * 24, ["a"] * 500, ["x", *["a"] * 30, "y"], aab * 8, aab * 8 + ["a"], list("abcdefgh") * 3, list("abcdefgh") * 3 + ["a", "b"], list("abcdefghi") * 2])
    # a run inside the period of another one, and two that overlap
    check([(["a"] * 40 + list("bcd")) * 4, list("ab") * 20 + list("ba") * 20, (["a"] * 32 + ["b"] * 32 + ["a"] * 64 + ["b"] * 64) * 3])
    # widths that end in one text and begin in the next
    check([list("abc") * 5, list("abc") * 5, list("abc") * 9, [], ["a"]])


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_random_against_brute_force(data):
    rng = random.Random(data.draw(st.integers(0, 10**9)))
    texts = []
    for _ in range(3):
        t = []
        while len(t) < rng.randint(0, 400):
            block = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, rng.choice([3, 9, 17, 40, 70])))]
            t += (block * rng.randint(1, 8))[: rng.randint(1, 300)]
        texts.append(t)
    check(texts)


def test_long_periods():
    rng = random.Random(3)
    for q in (15, 16, 17, 31, 32, 33, 63, 64, 65, 127, 128, 129, 200):
        block = [str(rng.randint(0, 10**6)) for _ in range(q)]
        check([block * 3, (block * 4)[: 3 * q + 5], (block * 3)[: 3 * q - 1], ["x", "y", *block * 3, block[0], "z"]])


def test_collapsed_keeps_one_period():
    words = [w.encode() for w in ["s", *list("abc") * 10, "e"]]
    assert collapsed(words, runs_of([words])[0]) == [b"s", b"a", b"b", b"c", b"e"]


def test_query_against_brute_force_and_its_sql(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len((r["text"] or "").split()) < 900]
    rows = [(r["doc_id"], r["text"]) for r in rows] + [(10_000 + i, " ".join(["la"] * i)) for i in range(20, 60)] + [(7, None), (8, ""), (9, " \n ")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = periodic_runs(frame).collect()
    want = []
    for d, t in rows:
        words = spiked(d, (t or "").encode().split())
        want.append(digests(d, words, brute(words)))
    order = lambda rs: sorted(map(tuple, rs), key=str)
    assert order(got) == order(want) and sum(r["n_runs"] > 0 for r in got) > 40
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    out = db.execute(ORACLES["op13_periodic_runs"])
    assert [c[0] for c in out.description] == got[0].__fields__
    assert order(out.fetchall()) == order(want)


def test_hard_rows(spark):
    rows = hard_rows(spark)
    got = periodic_runs(rows).collect()
    want = [digests(r["doc_id"], w := spiked(r["doc_id"], (r["text"] or "").encode().split()), runs_of([w])[0]) for r in rows.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert periodic_runs(empty(spark)).count() == 0
    kept = with_runs(docs(spark, ["a " * 30]), ["doc_id", "kept", "row_key"]).first()
    assert kept["kept"].asDict() == {"doc_id": 0, "kept": "k", "row_key": 1} and kept["collapsed"] == "a" and [tuple(r) for r in kept["runs"]] == [(0, 30, 1)]


def test_very_repetitive_texts_stay_near_linear():
    took = []
    for n in (100_000, 400_000):
        words = [b"a", b"b"] * (n // 4) + [b"c"] * (n // 2)
        begun = time.process_time()
        assert runs_of([words])[0] == [(0, n // 2, 2), (n // 2, n // 2, 1)]
        took.append(time.process_time() - begun)
    assert took[1] < 8 * took[0] + 0.5
