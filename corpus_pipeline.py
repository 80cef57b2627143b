"""The corpus pipeline: documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assaykit.llm import contamination, jaccard, languages, packing, secrets
from assaykit.session import scratch_path
from assaykit.sources.tables import parquet

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows of an Arrow batch in this job: texts can be long, and the stages share their executors' memory.
BATCH_ROWS = 1_000


def short_batches(stage: Stage) -> Stage:
    """The stage with Arrow batches of BATCH_ROWS rows, set for the session it runs in."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@short_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: a model fitted on their own labels, applied to their texts."""
    return languages.keep_known(docs)


@short_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity."""
    return jaccard.keep_one(docs)


@short_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return contamination.drop_contaminated(docs, parquet(spark, sf_dir, "benchmark"))


@short_batches
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secrets.redact(docs)


@short_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of packed sequences. The word table is small: the workers have
    served the stages before, beside an executor whose heap has grown."""
    return packing.pack(docs, cached_words=150_000)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Language proportions by expectation-maximisation and tokenisers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and reread."""
    docs = parquet(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
