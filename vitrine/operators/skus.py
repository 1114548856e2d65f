"""Unique seller SKUs by a first-wins rule, as a distributed fixpoint.

The rule, row after row in order: a row takes its base if nobody has it; else it
tries ``base-suffix``, ``base-suffix-2``, ``base-suffix-3`` … until one is free.

Read as a matching this is serial dictatorship: every row has a list of names it
would take, and an earlier row always beats a later one.  Such a matching has one
stable outcome, whatever the order in which rows are turned away.  So all rows
claim at once; where several claim the same name the earliest keeps it and the
others move down their lists, until nobody is turned away.  A row may also skip
every name that an earlier row of the same list was already turned away from or
holds, which moves all repeats of a base to their final name in the first round;
further rounds happen only where a made-up name meets another base, and work on the
names and lists that the round before touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.sqltext import first_filled
from vitrine.functions.text import clean_text, sku_suffix
from vitrine.functions.urls import slug_from_url
from vitrine.operators.ranking import ROWS_PER_BUCKET, ranked, running_max, with_bucket
from vitrine.session import scratch_path

ORDER = ["url_ord", "var_idx"]
_POSITION = "struct(url_ord, var_idx)"
_CLAIM = "CASE WHEN step = 0 THEN base WHEN step = 1 THEN root ELSE concat(root, '-', step) END"


def sku_base() -> str:
    return clean_text(first_filled("seller_sku", "listing_id", slug_from_url("product_url")))


def sku_claims(rows: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``(url_ord, var_idx, base, root, n)``: base, first made-up name, count of the base so far."""
    slim = rows.selectExpr(*ORDER, f"{sku_base()} AS base", f"{first_filled('variation_variant_1', 'item_name')} AS own")
    numbered = ranked(with_bucket(slim, "url_ord", rows_per_bucket), ["base"], ORDER, "n")
    suffix = sku_suffix(first_filled("own", "CAST(n AS STRING)"))
    return numbered.selectExpr(
        *ORDER, "__bucket", "base", f"CASE WHEN base = '' THEN {suffix} ELSE concat(base, '-', {suffix}) END AS root", "n"
    )


class _Moves:
    """Rows that left their base, a folder of small tables, one per round, in the shared folder.

    Steps only grow, so the largest step of a row is its present one; a round writes the rows that it moved.
    """

    SCHEMA = "url_ord long, var_idx int, __bucket long, base string, root string, step long"

    def __init__(self, spark):
        self.spark, self.path, self.rounds = spark, scratch_path(spark, "sku-moves"), 0

    def add(self, rows: DataFrame) -> DataFrame:
        """Write the round's rows; returns them as a table."""
        own = f"{self.path}/round={self.rounds}"
        self.rounds += 1
        columns = [c.split()[0] for c in self.SCHEMA.split(", ")]
        rows.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in (x.split() for x in self.SCHEMA.split(", "))]).write.parquet(own)
        return self.spark.read.schema(self.SCHEMA).parquet(own).select(*columns)

    def latest(self) -> DataFrame:
        """Present state of all rows that ever moved, with ``claim``."""
        every = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        last = every.groupBy(*ORDER).agg(F.max(F.struct("step", "__bucket", "base", "root")).alias("s"))
        return last.selectExpr(*ORDER, "s.__bucket", "s.base", "s.root", "s.step").selectExpr("*", f"{_CLAIM} AS claim")


def _advanced(listed: DataFrame) -> DataFrame:
    """Rows of the touched lists that move, with their new ``step``.

    ``floor_step`` is the first name a row can still get.  In list order the next
    step is ``rank + running max(floor_step - rank)``: at least the own floor, and
    one more than the row before.
    """
    placed = ranked(listed, ["root"], ORDER, "rank").withColumn("slack", F.expr("floor_step - rank"))
    stepped = running_max(placed, ["root"], ORDER, "slack", "lead")
    moved = stepped.selectExpr(*ORDER, "__bucket", "base", "root", "step", "rank + lead AS new_step").where("new_step > step")
    return moved.selectExpr(*ORDER, "__bucket", "base", "root", "new_step AS step")


def _touched_lists(away: DataFrame, moves: _Moves) -> DataFrame:
    """All rows in the lists of the rows that were turned away: these and the ones that moved earlier."""
    state = [*ORDER, "__bucket", "base", "root", "step"]
    held = moves.latest().join(away.select("root").distinct(), "root", "left_semi").select(*state).withColumn("floor_step", F.col("step"))
    pushed = away.select(*state).withColumn("floor_step", F.col("step") + 1)
    return held.unionByName(pushed).groupBy(*state).agg(F.max("floor_step").alias("floor_step"))


def _turned_away(base: DataFrame, delta: DataFrame, moves: _Moves) -> DataFrame:
    """Rows whose claimed name is claimed by an earlier row too, looked for among the names that the last round claimed.

    All other names were settled before: nobody has come to them since.
    """
    names = delta.selectExpr(f"{_CLAIM} AS claim").distinct()
    latest = moves.latest()
    state = [*ORDER, "__bucket", "base", "root", "step", "claim"]
    still = base.selectExpr(*ORDER, "__bucket", "base", "root", "0L AS step", "base AS claim").join(names, "claim", "left_semi")
    claimants = still.join(latest.select(*ORDER), ORDER, "left_anti").select(*state).unionByName(
        latest.join(names, "claim", "left_semi").select(*state)
    )
    contested = (
        claimants.groupBy("claim")
        .agg(F.min(F.expr(_POSITION)).alias("best"), F.count(F.lit(1)).alias("claimants"))
        .where("claimants > 1")
        .select("claim", "best")
    )
    return claimants.join(contested, "claim").where(f"{_POSITION} > best").select(*state[:-1])


def _stored(spark, frame: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _settled(rows: DataFrame, rows_per_bucket: int) -> tuple[DataFrame, DataFrame]:
    """The claims of all rows, written once, and the rows that ended up with another name than their base.

    A semi-naive loop: a round looks at the names that the round before claimed, moves rows in the lists of
    those that were turned away, and writes what it moved.
    """
    spark = rows.sparkSession
    base = _stored(spark, sku_claims(rows, rows_per_bucket), "sku-claims")
    moves = _Moves(spark)
    # repeats of a base are turned away by its first row: known without a look at the claims
    repeats = base.where("n > 1").selectExpr(*ORDER, "__bucket", "base", "root", "0L AS step", "1L AS floor_step")
    delta = moves.add(_advanced(repeats))
    while not delta.isEmpty():
        away = _stored(spark, _turned_away(base, delta, moves), "sku-away")
        if away.isEmpty():
            break
        delta = moves.add(_advanced(_touched_lists(away, moves)))
    return base, moves.latest()


def resolve_skus(rows: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``(url_ord, var_idx, base, unique_sku)`` for rows with the product-row key columns."""
    base, moved = _settled(rows, rows_per_bucket)
    return base.select(*ORDER, "base").join(moved.select(*ORDER, "claim"), ORDER, "left").selectExpr(
        *ORDER, "base", "coalesce(claim, base) AS unique_sku"
    )


def unique_skus(rows: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Product rows with unique ``seller_sku``; ``(url_ord, var_idx)`` must be a key of the rows.

    The rows are written once to the shared folder first, so that pages are not
    read and cut again for every round; the rounds only write the rows that they move,
    and at the end only these meet the rows again.
    """
    columns = rows.columns
    stored = _stored(rows.sparkSession, rows, "product-rows")
    if not stored.groupBy(*ORDER).count().where("count > 1").isEmpty():
        raise ValueError("url_ord and var_idx must tell the product rows apart")
    changed = _settled(stored, rows_per_bucket)[1].selectExpr(*ORDER, "claim AS unique_sku")
    named = stored.join(changed, ORDER, "left").withColumn("seller_sku", F.coalesce("unique_sku", F.expr(sku_base())))
    return named.select(*columns)
