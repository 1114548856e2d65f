"""Page tables and the raw export as inputs."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.functions.sqltext import lit
from vitrine.operators.discovery import densely_numbered, limited, stored
from vitrine.schemas import PAGES, PRODUCT_ROW


def read_pages(spark: SparkSession, path: str, spread: int = 0) -> DataFrame:
    """Stored pages ``(page_id, url, html)``.

    A row group is one task however few bytes a task may read, and cutting HTML is slow work: a scan of fewer
    tasks than ``spread`` (the cores, say) deals the pages to that many first.  Larger tables are read in place.
    """
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return pages.repartition(spread) if pages.rdd.getNumPartitions() < spread else pages


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, url)`` of stored pages, for work that needs no HTML."""
    return spark.read.parquet(path).select("page_id", "url")


#: Files of a wave: their paths and numbers are broadcast, some 20 MB.
FILES_A_WAVE = 100_000


def _plain(path: str) -> str:
    """The path with its pattern characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_html_files(spark: SparkSession, path: str, limit: int = 0, wave: int = FILES_A_WAVE) -> DataFrame:
    """HTML files as pages: undecodable bytes dropped, the file address as URL, numbered in path order.

    ``limit`` counts files.  Paths are numbered first, without a look at the contents.  Then every task opens files
    of its own and numbers them by a broadcast of the paths, ``wave`` files at a time, so contents are
    read once, where they are used, and never shuffled; files beyond the limit are never opened.
    """
    paths = spark.read.format("binaryFile").load(path).selectExpr("path AS position", "path")
    numbered = stored(densely_numbered(limited(paths, limit)), "html-files")
    known = numbered.count()
    html = "CASE WHEN is_valid_utf8(raw) THEN raw ELSE replace(make_valid_utf8(raw), decode(X'EFBFBD', 'UTF-8'), '') END"
    pages = spark.createDataFrame([], PAGES)
    for first in range(0, known, wave):
        own = numbered.where(f"position >= {first} AND position < {first + wave}")
        # the driver's file index holds these paths anyway
        files = spark.read.format("binaryFile").load([_plain(r["path"]) for r in own.select("path").toLocalIterator()])
        near = files.select("path", "content").join(F.broadcast(own), "path")
        text = near.selectExpr("position AS page_id", "path AS url", "CAST(content AS STRING) AS raw")
        pages = pages.unionByName(text.selectExpr("page_id", "url", f"{html} AS html"))
    return pages


#: What ends a quoted record is known only with the parity of all quotes before it.
QUOTES = "length(value) - length(replace(value, '\"', ''))"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, first, record)``: the records of CSV files, cut in parallel; ``first`` marks the one that begins a file.

    Files are read by ranges of bytes.  A line begins a record if the number of quotes before it in its file is
    even: quotes are counted per range, the counts of the ranges before are summed (a row per range), and a range
    counts on within itself.  Lines that are whole records stay as they are; the lines of longer records meet by the
    place of their first line, which a range that begins inside a record learns from the ranges before it.

    Quotes must be doubled inside quoted fields and fields that hold quotes must be quoted, as CSV writers do.
    Lines end with a line feed; a carriage return before it belongs to a quoted field or is dropped at the record's end.
    """
    lines = spark.read.option("lineSep", "\n").text(path).selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS id", "value"
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    odd = lines.groupBy("file", "block").agg(F.expr(f"sum({QUOTES})").alias("quotes")).select(
        "file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("file", "block").orderBy("id")
    counted = lines.join(odd, ["file", "block"]).select(
        "file", "block", "id", "value", F.expr(QUOTES).alias("quotes"),
        (F.col("before") + F.coalesce(F.sum(F.expr(QUOTES)).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("until"),
        (F.row_number().over(within) == 1).alias("opens"),
    )
    begun = counted.withColumn("begins", F.expr("until % 2 = 0")).withColumn(
        "start", F.max(F.expr("CASE WHEN begins THEN id END")).over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    placed = stored(begun.selectExpr("file", "block", "id", "value", "block = 0 AND opens AS first", "begins AND quotes % 2 = 0 AS whole", "start"), "csv-lines")
    # where the record began that a range begins inside of
    reached = placed.groupBy("file", "block").agg(F.max("start").alias("start")).select(
        "file", "block", F.last(F.when(F.col("start").isNotNull(), F.struct("block", "start")), ignorenulls=True).over(earlier).alias("carried")
    )
    parts = placed.where("NOT whole").join(reached, ["file", "block"]).selectExpr(
        "file", "coalesce(CASE WHEN start IS NOT NULL THEN named_struct('block', block, 'start', start) END, carried) AS record_at",
        "named_struct('block', block, 'id', id, 'first', first, 'value', value) AS line",
    )
    longer = parts.groupBy("file", "record_at").agg(F.array_sort(F.collect_list("line")).alias("lines")).selectExpr(
        "file", "lines[0].first AS first", "array_join(transform(lines, l -> l.value), '\n') AS record"
    )
    every = placed.where("whole").selectExpr("file", "first", "value AS record").unionByName(longer)
    return every.selectExpr("file", "first", "regexp_replace(CASE WHEN first THEN trim(LEADING '\ufeff' FROM record) ELSE record END, '\\r$', '') AS record")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header in every file, all columns as text: what ``multiLine`` reads in one task a file, read in parallel."""
    records = csv_records(spark, path)
    head = spark.read.option("lineSep", "\n").text(path).where("value <> ''").head()
    if head is None:
        return spark.read.csv(path)
    names = next(csv.reader([head["value"].lstrip("\ufeff").rstrip("\r")]))
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    options = "map('escape', '\"', 'multiLine', 'true')"
    rows = records.where("NOT first AND trim(record) <> ''")
    return rows.selectExpr(f"from_csv(record, {lit(schema)}, {options}) AS row").select("row.*")


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw export back from CSV: quoted line breaks, doubled quotes, optional byte-order mark."""
    read = read_csv(spark, path)
    arrays = {"item_notes", "images"}
    return read.selectExpr(
        *[
            f"filter(split(coalesce({c}, ''), ' [|] '), x -> x <> '') AS {c}" if c in arrays
            else f"CAST({c} AS DOUBLE) AS {c}" if c == "map_price"
            else f"coalesce({c}, '') AS {c}"
            for c in PRODUCT_ROW.names
        ]
    )
