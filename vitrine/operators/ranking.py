"""Ranks and running maxima that do not put a whole key into one task.

A window over a key that holds a third of the rows would sort that third in one
task.  Here the order is cut into buckets (ranges of the order column): windows
run per ``(key, bucket)``, and the sums or maxima of the earlier buckets come
from a table with one row per key and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1 << 18


def with_bucket(rows: DataFrame, order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Bucket number that grows with a dense order column."""
    return rows.withColumn("__bucket", F.expr(f"{order} DIV {rows_per_bucket}"))


def _with_earlier(rows: DataFrame, keys: list[str], summary: Column, over_earlier) -> DataFrame:
    """Join the summary of a key's earlier buckets as ``__earlier``."""
    per_bucket = rows.groupBy(*keys, "__bucket").agg(summary.alias("__summary"))
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = per_bucket.select(*keys, "__bucket", over_earlier("__summary").over(earlier).alias("__earlier"))
    return rows.join(sums, [*keys, "__bucket"])


def ranked(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``row_number`` per key in the given order; ``rows`` must carry ``__bucket``."""
    window = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    counted = _with_earlier(rows, keys, F.count(F.lit(1)), F.sum)
    local = F.row_number().over(window)
    return counted.withColumn(name, local + F.coalesce("__earlier", F.lit(0))).drop("__earlier")


def running_max(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Maximum of ``value`` over the key's rows up to this one; needs ``__bucket``."""
    window = Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = _with_earlier(rows, keys, F.max(value), F.max)
    local = F.max(value).over(window)
    return summed.withColumn(name, F.greatest(local, F.coalesce("__earlier", local))).drop("__earlier")
