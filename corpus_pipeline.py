"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A stage works
on all rows that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import decontam, langid, neardup, packing, pii, tokens
from corvid.llm.common import session, table

#: A text counts as language if at least this share of its n-grams belongs to the language it is closest to.
MIN_COVERAGE = 0.3

#: Rows that a Python worker gets at a time. Texts are long: a default batch of 10,000 is held several times over, in the executor and in the worker.
ARROW_ROWS = "1000"


def bounded(spark: SparkSession) -> None:
    """Sets the session's Arrow batches for what the stages run; the stages are executed after they return."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a language that the labelled rows teach; texts without letters and strings that are no
    language go. A row is judged by n-grams that another text of the language holds, so a label doesn't cover its own text.
    Without any labelled row there is nothing to judge by, and rows with a letter stay."""
    bounded(spark)
    return langid.recognised(docs, langid.fit(docs, shared=True), MIN_COVERAGE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: five-word shingles, similarity 0.8."""
    bounded(spark)
    return neardup.deduplicated(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item: five-word shingles, containment 0.8."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=5, threshold=0.8)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the spans of personal data and secrets masked by their kind; n_chars follows the text."""
    bounded(spark)
    masked = pii.redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in windows of 1024 tokens."""
    bounded(spark)
    return packing.pack(docs, tokens.named("byte_bpe_50k.json"), 1024, 0)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: Language ID, tokenization and packing have no SQL; tests/llm tests the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = table(docs)
    return docs
