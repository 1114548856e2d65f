"""SimHash near-duplicates by multi-index hashing.

The 64-bit fingerprint is cut into two halves. Two fingerprints that differ in at most two bits have a half
in which they differ in at most one (pigeonhole), so every fingerprint looks up the Hamming ball of radius
one around each of its halves (33 values) in that half's table, and the complete distance decides. Only
distinct fingerprints take part; documents follow by their fingerprint. Groups are connected components.

Cases: null or wordless text has fingerprint 0, linked like any other. Fewer than three words form one
shingle. A null ``doc_id`` is never the smallest of a group; a group of null ids alone has a null
component. Repeated rows share their fingerprint and are returned each. Empty tables give no rows.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import byte_table, components, map_arrow, merged_by_key, stage

SHINGLE, SEED, NEAR = 3, 42, 2
LOWER = byte_table(gaps=False)


def fingerprint(text: bytes | None) -> int:
    """Bit i is set if it is set in more than half of the shingle hashes, repeats included."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    hashes = np.array([digest(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:], strict=False)], dtype="<u8")
    n, set_bits = len(hashes), np.zeros(64, dtype=np.int64)
    for k in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * set_bits > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """kept (struct of ``keep``) and fp, the fingerprint as a signed long."""
    inner = docs.select(F.struct(*keep).alias("kept"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(values)], names=["kept", "fp"])

    return map_arrow(inner, run, inner.select("kept").schema.add("fp", "long"))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b), a < b: distinct fingerprints ``fp`` that differ in one or two bits."""
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.col("fp").bitwiseAND(0xFFFFFFFF).alias("value")),
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned("fp", 32).alias("value")),
    )
    index = distinct.select("fp", F.inline(halves))
    ball = F.expr("concat(array(0L), transform(sequence(0, 31), i -> shiftleft(1L, i)))")
    probes = index.select(F.col("fp").alias("a"), "half", "value", F.explode(ball).alias("flip")).select("a", "half", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    table = index.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= NEAR
    return probes.join(merged_by_key(table), (probes.half == table.half) & (probes.value == table.value) & (F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def grouped(prints: DataFrame) -> DataFrame:
    """fp and component_id, the smallest doc_id reachable; ``prints`` has doc_id and fp."""
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    reached = components(links(distinct), "simhash").withColumnRenamed("id", "fp")
    named = distinct.join(merged_by_key(reached), "fp", "left").select("fp", "doc_id", F.coalesce("component_id", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(merged_by_key(smallest), "root").select("fp", "component_id")


def simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    prints = stage(fingerprints(docs, ["doc_id"]).select("kept.doc_id", "fp"), "simhash-prints")
    return prints.join(merged_by_key(grouped(prints)), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
