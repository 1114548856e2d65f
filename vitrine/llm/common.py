"""Helpers that several operators share: staging, numbering, components, word rules."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.session import scratch_path

#: Fixed value: the characters that separate words in the word contracts (all below U+0080).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it again: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more: its cleaner works when the driver collects garbage.

    For operators whose later steps read written tables only; else shuffles of all steps stay on disk until the driver's next collection.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def merged_by_key(df: DataFrame) -> DataFrame:
    """``df`` for a join that is never broadcast, for tables that grow with the input.

    Spark sizes a written table by its compressed files and rows behind an explode as if each stayed one, so a side of many times
    the broadcast limit would be collected by the driver.
    """
    return df.hint("merge")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def map_arrow(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` in batches of ``BATCH_BYTES``, so that long texts don't fill a worker; unless the session sets a size.

    Workers find this package where the driver has it, whatever their working folder.
    """
    spark = frame.sparkSession
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return frame.mapInArrow(run, schema)


def with_kept(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``kept``, a struct of the columns, and ``text`` unless it is one of them: long texts travel once."""
    kept = F.struct(*keep).alias("kept")
    return docs.select(kept) if "text" in keep else docs.select(kept, "text")


def texts_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of ``with_kept`` rows."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("kept").field("text")


def byte_table(gaps: bool) -> bytes:
    """For ``bytes.translate``: A-Z lowered; with ``gaps`` every separator of ``GAP`` becomes a space."""
    out = bytearray(range(256))
    for b in range(128):
        letter = 65 <= b <= 90
        if letter:
            out[b] = b + 32
        elif gaps and not (48 <= b <= 57 or 97 <= b <= 122):
            out[b] = 32
    return bytes(out)


def numbered(df: DataFrame, key: str, order: list[str], name: str, rows: int) -> DataFrame:
    """``name``: gapless numbers from 0 within ``key`` (never null), by hash bucket, then ``order``.

    A key that holds a third of all rows is numbered by many tasks: rows are ranked per (key, bucket)
    and the sizes of the earlier buckets are added. ``df`` is read twice, so pass a staged table.
    """
    buckets = max(16, rows // 50_000)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_rank", F.row_number().over(within).cast("long") - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_rank"))
        .drop("_bucket", "_before", "_rank")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component_id) of every id in the undirected ``edges`` (a long, b long): smallest id reachable.

    Each round takes the smallest label among the neighbours and then follows labels once more, so a
    chain of n links needs about log2(n) rounds. The labels of a round are a written table, edges and
    labels stay distributed and the driver only learns whether anything changed.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{name}-links")
    labels = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), f"{name}-labels")
    while True:
        near = (
            both.join(merged_by_key(labels.select(F.col("id").alias("b"), "label")), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        met = labels.join(merged_by_key(near), "id").select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = met.select(F.col("id").alias("label"), F.col("label").alias("further"))
        after = stage(
            met.join(merged_by_key(jump), "label", "left").select("id", "was", F.least("label", F.coalesce("further", "label")).alias("label")),
            f"{name}-labels",
        )
        labels = after.select("id", "label")
        if after.where("label <> was").isEmpty():
            return labels.withColumnRenamed("label", "component_id")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
