"""The corpus pipeline: language ID, near-duplicates, decontamination, personal data, packing.

A stage takes what its predecessor kept and returns the columns of documents; the last one returns the
pieces of the packed sequences. Nulls, ties, repeated rows and empty tables are as the operators state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitrine.llm.common import release, stage, table
from vitrine.llm.decontamination import drop_contaminated
from vitrine.llm.language_id import keep_identified
from vitrine.llm.near_duplicates import keep_one
from vitrine.llm.packing import packing
from vitrine.llm.pii import masked
from vitrine.llm.queries import TOKENIZER
from vitrine.session import clear_scratch, scratch_mark


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay."""
    return keep_identified(docs)


def thin_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, Jaccard of 0.8 or more) stays, that of the smallest doc_id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their text is replaced by its kind."""
    return masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of at most 4096."""
    return packing(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language_id", identify), ("simhash", thin_out), ("decontamination", decontaminate), ("pii", redact), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's rows are written and read again."""
    docs, begun = table(spark, sf_dir, "documents"), scratch_mark()
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        clear_scratch(spark, begun, kept=1)  # what its operators wrote and the rows before it; its own rows stay
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
