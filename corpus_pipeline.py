"""Documents to packed training windows, in five stages.

Each stage is one operator of ``postlytics.llm`` applied to all rows its
predecessor kept; its output is written as Parquet and read again.

Defined results: columns beside those of ``COLUMNS`` are left out before the first operator, so their names
can't clash. A null text counts as the empty text in every stage and stays null until it is packed, as its end
id alone; an empty or null text is near no other, and stays unless a row with its id repeats it. Of rows that repeat as
a whole, and of a group of near copies, one row stays, that of the smallest doc_id; rows without an id come after all
others and carry no label. Without labels of both kinds no text is rejected unless all labels say so, and without findings
the fixed patterns alone are redacted. Texts of any length are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlytics.llm import minhash, mixing, packing, secret_scan, toxicity
from postlytics.llm.common import read_table, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    docs = docs.select(*COLUMNS)
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8."""
    docs = docs.select(*COLUMNS)
    return minhash.drop_near_duplicates(docs, words=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    docs = docs.select(*COLUMNS)
    return secret_scan.redact(docs, secret_scan.train(staged(secret_scan.scan(docs), "scanned")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mixed_rows(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their window and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Classifier, signatures and tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
