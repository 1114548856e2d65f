"""Raw export and marketplace feed."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vitrine import fixed
from vitrine.operators.discovery import densely_numbered
from vitrine.schemas import PRODUCT_ROW
from vitrine.session import scratch_path

_REPEATS = {"item_note": fixed.MAX_NOTES, "other_image_url": fixed.MAX_IMAGES - 1}


def default_template() -> list[str]:
    """Header of the feed: repeated names stand for repeated columns."""
    names = [n for c in fixed.FEED_COLUMNS for n in [c] * _REPEATS.get(c, 1)]
    return names + list(fixed.FEED_EMPTY_COLUMNS)


def raw_export(rows: DataFrame) -> DataFrame:
    """All product-row columns in their order, arrays joined."""
    return rows.select(
        *[
            F.array_join(c, " | ").alias(c) if c in ("item_notes", "images") else F.col(c)
            for c in PRODUCT_ROW.names
        ]
    )


def feed(rows: DataFrame, template: list[str] | None = None, *more: str) -> DataFrame:
    """Project product rows to the template's columns, after ``more`` columns of theirs.

    A value goes to the first column of its name; notes and further images are
    spread over all columns of theirs, surplus values are dropped, and columns
    nobody fills are NULL.  Repeated names are numbered.
    """
    template = template or default_template()
    total, seen, columns = Counter(template), Counter(), []
    for name in template:
        seen[name] += 1
        n = seen[name]
        field = fixed.FEED_COLUMNS.get(name)
        if name == "item_note":
            value = f"get(item_notes, {n - 1})"
        elif name == "main_image_url":
            value = "get(images, 0)" if n == 1 else "CAST(NULL AS STRING)"
        elif name == "other_image_url":
            value = f"get(images, {n})" if n < fixed.MAX_IMAGES else "CAST(NULL AS STRING)"
        elif field and n == 1:
            value = field
        else:
            value = "CAST(NULL AS STRING)"
        spread = total[name] > 1 or name in _REPEATS
        columns.append(f"{value} AS `{name}_{n}`" if spread else f"{value} AS `{name}`")
    return rows.selectExpr(*more, *columns)


def in_order(rows: DataFrame) -> DataFrame:
    """Product rows with ``row_no``, their dense place in the sheet from 0, and sorted by it within every written file.

    Ranges of the order are sorted apart; a reader restores the sheet with ``orderBy("row_no")`` or reads the files by name.
    """
    placed = rows.withColumn("position", F.array(F.col("url_ord").cast("bigint"), F.col("var_idx").cast("bigint")))
    return densely_numbered(placed).withColumnRenamed("position", "row_no").sortWithinPartitions("row_no")


def feed_in_order(rows: DataFrame, template: list[str] | None = None) -> DataFrame:
    """The feed with ``row_no`` before its columns."""
    return feed(in_order(rows), template, "row_no")


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with header and doubled quotes; texts may hold line breaks."""
    frame.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


@dataclass(frozen=True)
class RunCounts:
    """What a run found and wrote; false when nothing was exported."""

    urls_found: int
    rows_exported: int

    def __bool__(self) -> bool:
        return self.rows_exported > 0


def write_counted(frame: DataFrame, path: str) -> int:
    """Write as parquet; the number of rows, observed by the tasks that write.

    The observation stands directly below the write, whose tasks count once each however often an executor is lost.
    """
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return seen.get.get("rows", 0)


def stored_counted(frame: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write to the shared folder and read back, with the number of rows."""
    path = scratch_path(frame.sparkSession, name)
    rows = write_counted(frame, path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), rows


def write_feed(rows: DataFrame, path: str, raw_path: str | None = None, template: list[str] | None = None, urls_found: int = 0) -> RunCounts:
    """Write the feed (and the raw export) as parquet; nothing is written when there are no rows.

    The rows are computed once, into the shared folder, where they are counted, and read for each output.
    ``urls_found`` comes from the run that made the list (``stored_counted``).
    """
    stored, exported = stored_counted(rows, "feed-rows")
    if exported:
        feed(stored, template).write.parquet(path)
        if raw_path:
            raw_export(stored).write.parquet(raw_path)
    return RunCounts(urls_found, exported)
