"""The training-data pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lloydflow.llm.common import stored, table, unboxed
from lloydflow.llm.jaccard_join import one_per_class
from lloydflow.llm.lang_id import accepted
from lloydflow.llm.line_dedup import dedup_lines
from lloydflow.llm.mixing import mixed_documents
from lloydflow.llm.packing import pack


#: Words that a Python worker keeps encoded: its memory is shared with the other stages.
KEPT_WORDS = 200_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read as no learnt language go: without a letter, or with a cosine far below their length's.

    Null and empty texts go with them; where no language can be learnt every text with a letter
    stays.  Equal rows share their fate; all columns are kept as they are.
    """
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents keep; ``n_chars`` follows the new text.

    Every document stays, a null text as an empty one; of a repeated line the largest doc_id keeps it,
    rows of that doc_id alike.  All other columns are kept as they are.
    """
    out = dedup_lines(docs)
    return unboxed(out, docs.columns, text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest doc_id, null ids last, then by the text's hash.

    Of equal rows one stays; texts without a word have no duplicates.  All columns are kept as they are.
    """
    return one_per_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them, none to a few times.

    A null source is a source of its own; a document without a word is not taken.  All columns are kept as
    they are.
    """
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: every piece with its sequence and place.

    Rows that repeat a doc_id are packed each for itself, long texts in pieces, empty ones as an end id;
    other columns are not read.
    """
    return pack(docs, entries=KEPT_WORDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Learnt language profiles, the mix and the packing are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
