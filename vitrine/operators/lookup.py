"""Choosing pages by number while their HTML stays where it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 2^25 make a broadcast of at most 524,288 rows of two numbers, however long the list is.
FILTER_BITS = 1 << 25
WORD = 64


def number_filter(numbers: DataFrame, column: str = "page_id", bits: int = FILTER_BITS) -> DataFrame:
    """``(word, bits)``: a bitmap of the hashed numbers, at most ``bits / 64`` rows."""
    hashed = numbers.where(f"{column} IS NOT NULL").selectExpr(f"pmod(xxhash64(CAST({column} AS BIGINT)), {bits}L) AS h")
    return hashed.groupBy(F.expr(f"h DIV {WORD}").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST(h % {WORD} AS INT)))").alias("bits")
    )


def maybe_listed(frame: DataFrame, numbers: DataFrame, column: str = "page_id", bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose number may be in the list: all that are, and of the others the share that the bitmap's load lets through.

    The bitmap is broadcast, so the rows are neither moved nor sorted; who needs the list itself joins slim rows
    later.  Its size has a fixed bound, a list beyond it only lets more rows through.
    """
    hashed = f"pmod(xxhash64(CAST({column} AS BIGINT)), {bits}L)"
    word = number_filter(numbers, column, bits).selectExpr("word AS __word", "bits AS __bits")
    marked = frame.selectExpr("*", f"{hashed} AS __h").join(F.broadcast(word), F.expr(f"__h DIV {WORD} = __word"))
    return marked.where(f"{column} IS NOT NULL AND getbit(__bits, CAST(__h % {WORD} AS INT)) = 1").select(*[f"`{c}`" for c in frame.columns])


def surely_unlisted(frame: DataFrame, numbers: DataFrame, column: str = "page_id", bits: int = FILTER_BITS) -> DataFrame:
    """The rows that ``maybe_listed`` leaves out, null numbers among them."""
    hashed = f"pmod(xxhash64(CAST({column} AS BIGINT)), {bits}L)"
    word = number_filter(numbers, column, bits).selectExpr("word AS __word", "bits AS __bits")
    marked = frame.selectExpr("*", f"{hashed} AS __h").join(F.broadcast(word), F.expr(f"__h DIV {WORD} = __word"), "left")
    return marked.where(f"{column} IS NULL OR __bits IS NULL OR getbit(__bits, CAST(__h % {WORD} AS INT)) = 0").select(*[f"`{c}`" for c in frame.columns])
