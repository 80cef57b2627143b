"""Experiment runs kept as small files: one per parameter, one per metric, one meta file per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of the store, `<experiment>/<run>/{params,metrics}/<key>` and meta files.
RUN_FILE = r"([^/]+)/([^/]+)/(params|metrics)/([^/]+)$"
# The same layout as Spark writes it, one folder per key.
WRITTEN_RUN_FILE = r"([^/]+)/run=([^/]+)/kind=(params|metrics)/key=([^/]+)/[^/]+$"
RUN_META = r"([^/]+)/([^/]+)/meta\.yaml$"
EXPERIMENT_META = r"([^/]+)/meta\.yaml$"
META_FIELDS = ["run_id", "run_name", "start_time", "end_time", "status"]


def run_log(spark: SparkSession, root: str, layout: str = RUN_FILE) -> DataFrame:
    """Long form of the store: (experiment, run_id, kind, key, step, ts, value). `layout` finds
    experiment, run, kind and key in a path."""
    path = F.col("_metadata.file_path")
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(root)
        .select("value", path.alias("path"))
        .filter(F.col("path").rlike(layout))
    )
    parts = F.split("value", " ")
    metric = F.col("kind") == "metric"
    return lines.select(
        F.regexp_extract("path", layout, 1).alias("experiment"),
        F.regexp_extract("path", layout, 2).alias("run_id"),
        F.when(F.regexp_extract("path", layout, 3) == "metrics", "metric")
        .otherwise("param")
        .alias("kind"),
        F.regexp_extract("path", layout, 4).alias("key"),
        "value",
    ).select(
        "experiment",
        "run_id",
        "kind",
        "key",
        F.when(metric, F.try_element_at(parts, F.lit(3)).try_cast("bigint")).alias("step"),
        F.when(metric, F.get(parts, F.lit(0)).try_cast("bigint")).alias("ts"),
        F.when(metric, F.try_element_at(parts, F.lit(2))).otherwise(F.col("value")).alias("value"),
    )


def _meta_files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option(
        "pathGlobFilter", "meta.yaml"
    ).text(root, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))


def _field(name: str):
    found = F.regexp_extract("value", rf"(?m)^{name}:\s*'?([^'\n]*)'?\s*$", 1)
    return F.nullif(found, F.lit(""))


def run_meta(spark: SparkSession, root: str) -> DataFrame:
    """(experiment, run_id, run_name, start_time, end_time, status) from the run meta files."""
    files = _meta_files(spark, root).filter(_field("run_id").isNotNull())
    return files.select(
        F.regexp_extract("path", RUN_META, 1).alias("experiment"),
        *[_field(f).alias(f) for f in META_FIELDS],
    ).withColumns(
        {
            "start_time": F.col("start_time").try_cast("bigint"),
            "end_time": F.col("end_time").try_cast("bigint"),
        }
    )


def experiment_meta(spark: SparkSession, root: str) -> DataFrame:
    files = _meta_files(spark, root).filter(_field("run_id").isNull())
    return files.select(
        F.regexp_extract("path", EXPERIMENT_META, 1).alias("experiment"), _field("name").alias("name")
    )
