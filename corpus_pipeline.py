"""A training-data pipeline: each stage works on all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from alembiq.llm import bpe, decontam, exact_dedup, langid, simhash
from alembiq.llm.queries import tokenizer
from alembiq.llm.util import cut

#: Rows of whole texts that a Python worker and the JVM hold for it at a time; Spark's 10,000 are for short rows.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def batched(spark: SparkSession) -> None:
    """Set the batch size that is read when the stage's rows are written; ``run`` restores the caller's at its end."""
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


@contextmanager
def restored(spark: SparkSession, setting: str) -> Iterator[None]:
    """Give a setting back its value, or its absence, whatever happens to it inside."""
    before = spark.conf.get(setting, None)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected: no letters, or below the calibrated score."""
    batched(spark)
    return langid.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row of the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash keep the document of the least doc_id."""
    batched(spark)
    return simhash.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by the benchmark."""
    batched(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document, decoded again as proof."""
    batched(spark)
    path, pattern = tokenizer()
    return bpe.encode_texts(docs, path, pattern)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

#: The first stage's model can't be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; each stage's rows are a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with restored(spark, BATCH_SETTING):
        for name, stage in STAGES:
            docs = cut(stage(spark, docs, sf_dir), name)
    return docs
