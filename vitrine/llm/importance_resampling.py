"""Target-distribution importance resampling by bit-sliced aggregation.

Features (runs of one to ``longest`` words) are hashed into buckets. A bucket's gain is the rounded log ratio of its smoothed
share in the target table and in the documents. A document's weight is the sum of its features' gains; with Gumbel noise
by its id, the highest scores are a sample without replacement in proportion to the exponential of the weights.

Weights are summed bit by bit: plane k of a document holds bit k of its count for every bucket, plane j of the gains
bit j of their positive (or negative) parts. ``AND``, popcount and 2^(k+j) give the exact integer, whatever the counts.

Only bucket counts come to the driver, ``buckets`` longs a table; they are summed per task first. Ranks come from
ranges of the score's order, so nothing is sorted in one task.

Cases: null, empty and wordless texts have no features, weight 0 and a score by their id. Without a ``doc_id`` a row has no score,
is never drawn and doesn't count among those that a share is drawn from. Ties go to the smaller ``doc_id``, of repeated ids to
fewer features, then the smaller weight. Empty documents give no rows, an empty target no target counts. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import byte_table, map_arrow, stage

BUCKETS, LONGEST, SCALE = 10_000, 1, 1000
LEAST_WORDS, SHARE, SEED = 20, 10, 2024
WORDS = byte_table(gaps=True)
MEMO, BLOCK = 1 << 20, 512


class Features:
    """Words and buckets of texts; the buckets of features met before are kept, up to ``MEMO`` of them."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.memo = longest, buckets, {}

    def __call__(self, text: bytes | None) -> tuple[int, list[int]]:
        words = text.translate(WORDS).split() if text else []
        features = list(words)
        for n in range(2, self.longest + 1):
            features += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for f in set(features).difference(memo):
            memo[f] = zlib.crc32(f) % self.buckets
        return len(words), [memo[f] for f in features]


def _binary(rows: DataFrame, keep: list[str]) -> DataFrame:
    return rows.select(F.struct(*keep).alias("kept") if keep else F.lit(True).alias("kept"), F.col("text").cast("binary").alias("text"))


def bucket_counts(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts; a task sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(longest, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += np.bincount(np.array(features(text)[1], dtype=np.int64), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for row in map_arrow(_binary(rows, []), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded-down log ratios of the smoothed shares, times ``SCALE``."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def bitplanes(values: np.ndarray) -> list[np.ndarray]:
    """Plane j of non-negative ``values``: their bits j, packed into 64-bit words."""
    width = -(-len(values) // 64) * 64
    padded = np.zeros(width, dtype=np.int64)
    padded[: len(values)] = values
    return [np.packbits((padded >> j & 1).astype(bool), bitorder="little").view("<u8") for j in range(int(padded.max(initial=0)).bit_length())]


class Gains:
    """Signed gain bitplanes: (2^j with its sign, plane) of every plane that isn't empty."""

    def __init__(self, values: np.ndarray):
        self.planes = [(sign << j if sign > 0 else -(1 << j), p) for sign, part in ((1, np.maximum(values, 0)), (-1, np.maximum(-values, 0))) for j, p in enumerate(bitplanes(part)) if p.any()]
        self.words = -(-len(values) // 64)

    def weights(self, buckets: list[list[int]]) -> np.ndarray:
        """Exact sum of gains of every list of buckets."""
        sizes = np.array([len(b) for b in buckets])
        out = np.zeros(len(buckets), dtype=np.int64)
        if not sizes.sum():
            return out
        flat = np.fromiter((x for b in buckets for x in b), dtype=np.int64, count=int(sizes.sum()))
        span = self.words * 64
        keys, counts = np.unique(np.repeat(np.arange(len(buckets)), sizes) * span + flat, return_counts=True)
        for k in range(int(counts.max()).bit_length()):
            mine = keys[(counts >> k & 1).astype(bool)]
            if not len(mine):
                continue
            word = mine >> 6
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            owner = word[first] // self.words
            rows, row = np.unique(owner, return_inverse=True)
            plane = np.zeros((len(rows), self.words), dtype=np.uint64)
            plane[row, word[first] % self.words] = np.bitwise_or.reduceat(np.uint64(1) << (mine & 63).astype(np.uint64), first)
            total = np.zeros(len(rows), dtype=np.int64)
            for power, gain in self.planes:
                total += power * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
            out[rows] += total << k
        return out


def noise(doc_id: int | None, seed: int = SEED) -> int | None:
    """Gumbel noise of an id, rounded down, times ``SCALE``."""
    if doc_id is None:
        return None
    h = int(hashlib.sha256(b"%d:%d" % (seed, doc_id)).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, target: DataFrame, keep: list[str], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """kept, n_words, n_features and weight of every row of ``docs``."""
    gain = Gains(gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets)))
    inner = _binary(docs, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, buckets)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                found = [features(t) for t in part.column("text").to_pylist()]
                columns = [[n for n, _ in found], [len(b) for _, b in found], gain.weights([b for _, b in found])]
                yield pa.RecordBatch.from_arrays([part.column("kept"), *(pa.array(c, pa.int64()) for c in columns)], names=["kept", "n_words", "n_features", "weight"])

    return map_arrow(inner, run, inner.select("kept").schema.add("n_words", "long").add("n_features", "long").add("weight", "long"))


def scored(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` with score: weight plus the noise of ``doc_id``; null without an id."""
    inner = rows.select(F.struct(*rows.columns).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("kept")
            pairs = zip(kept.field("doc_id").to_pylist(), kept.field("weight").to_pylist(), strict=True)
            values = [None if i is None else w + noise(i, seed) for i, w in pairs]
            yield pa.RecordBatch.from_arrays([kept, pa.array(values, pa.int64())], names=["kept", "score"])

    return map_arrow(inner, run, inner.select("kept").schema.add("score", "long")).select("kept.*", "score")


def drawn(rows: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` (a written table) with rank: 1, 2, 3 ... of the ``share`` percent of highest scores, null for the others.

    Ranges of the order are numbered apart and shifted by the sizes of the ranges before them.
    """
    fit = rows.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull())
    others = rows.where(~((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()))
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = stage(
        fit.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "resampling-ranges",
    )
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    number = F.col("_start") + F.col("_place") + 1
    ranked = placed.join(starts, "_range").withColumn("rank", F.when(number <= F.floor(F.lit(share) * F.col("_all") / 100), number))
    return ranked.drop("_range", "_place", "_start", "_all").unionByName(others.withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    weights = weighted(docs, target, ["doc_id"]).select("kept.doc_id", "n_words", "n_features", "weight")
    rows = stage(scored(weights), "resampling-scores")
    return drawn(rows).select("doc_id", "n_features", "weight", "score", "rank")
