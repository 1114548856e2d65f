import random
import re

import xxhash
from helpers import SF, docs, empty, hard_rows

from vitrine.llm.simhash import links, simhash


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest member per member of the graph of fingerprints at most two bits apart."""
    name = {}
    for start in sorted(prints, key=lambda d: (d is None, d)):
        if start in name:
            continue
        open_ones = [start]
        while open_ones:
            d = open_ones.pop()
            if d not in name:
                name[d] = start
                open_ones += [e for e in prints if (prints[e] ^ prints[d]).bit_count() <= 2]
    return name


def test_whole_table_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    prints = {r["doc_id"]: brute(r["text"]) for r in table.collect()}
    want = groups(prints)
    got = simhash(table).collect()
    assert len(got) == len(prints)
    assert all(r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]] for r in got)


def test_links_are_all_pairs_within_two_bits(spark):
    rng = random.Random(1)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for _ in range(4):
            w = v
            for bit in rng.sample(range(64), rng.choice([1, 1, 2, 2, 3])):
                w ^= 1 << bit
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {frozenset((r["a"], r["b"])) for r in links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert got == want


def test_hard_rows(spark):
    table = hard_rows(spark)
    out = simhash(table).collect()
    assert len(out) == table.count()
    zero = [r for r in out if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    assert simhash(empty(spark)).count() == 0


def test_a_hot_group_stays_linear(spark):
    table = docs(spark, ["same words again and again"] * 500 + ["other words", "third set of words"])
    out = {r["doc_id"]: r["component_id"] for r in simhash(table).collect()}
    assert all(out[i] == 0 for i in range(500)) and out[500] == 500


def test_probes_are_not_broadcast(spark):
    """A fingerprint has 66 probes, which Spark sizes as one row: at 0.6 GB the driver collected all of them."""
    few = spark.createDataFrame([(i << 40,) for i in range(50)], "fp long")
    assert "Broadcast" not in links(few)._jdf.queryExecution().executedPlan().toString()
