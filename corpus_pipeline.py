"""A corpus pipeline: each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import fold
from furrow.llm.jaccard import one_of_each
from furrow.llm.language import in_known_language
from furrow.llm.mixing import mixed_documents
from furrow.llm.packing import pack_documents
from furrow.llm.secrets import masked_documents
from furrow.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ROWS_A_BATCH = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def long_rows(stage: Stage) -> Stage:
    """Whole texts go to Python and back ``ROWS_A_BATCH`` at a time, at most: the JVM and its workers hold several copies of a batch.

    The setting stays with the session, as a stage's rows are written after it returns.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_ROWS)) <= ROWS_A_BATCH:
            spark.conf.set(BATCH_ROWS, str(ROWS_A_BATCH))
        return stage(spark, docs, sf_dir)

    return run_stage


@long_rows
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language is known; the languages are learnt from three quarters of the labelled ones."""
    return in_known_language(docs, docs.where(fold(F.col("doc_id"), 4) != 2))


@long_rows
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


@long_rows
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret values masked."""
    return masked_documents(docs)


@long_rows
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


@long_rows
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("known_language", known_language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences)]

#: model scores, shingle joins and tokenising have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
