"""A corpus pipeline: each stage reads what the one before it kept, from Parquet in the shared folder.

Toxic documents go, one of each group of near-duplicates stays, documents with benchmark items go,
personal data is replaced by its kind, and what is left becomes sampled pieces. All stages but the last return
the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stored, table
from tidemart.llm.decontaminate import without_leaks
from tidemart.llm.near_dups import FIVE_WORDS, without_near_duplicates
from tidemart.llm.pieces import piece_report
from tidemart.llm.pii import redacted
from tidemart.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic. Labels are learned from those whose documents are here."""
    return without_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; five-word shingles, similarity 0.8."""
    return without_near_duplicates(docs.select(*COLUMNS), FIVE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, identifiers replaced."""
    shown = redacted(docs.select(*COLUMNS))
    return shown.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of all documents."""
    return piece_report(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

# A trained classifier, rewritten identifiers and sampled pieces have no SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
