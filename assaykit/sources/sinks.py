"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.schemas import RUN_LOG, conform


def index_csv(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").option("header", True).csv(path)


def master_parquet(master: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    master.write.mode("overwrite").partitionBy(*by).parquet(path)


def summary_csv(summary: DataFrame, path: str) -> None:
    """One header CSV. Only for tables that are already aggregated to a few rows."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def report_json(reports: DataFrame, path: str) -> None:
    reports.write.mode("overwrite").json(path)


def publish_cleaned(table: DataFrame, content: DataFrame, on: str, path: str) -> None:
    """The valid rows with their content, under split and class."""
    valid = table.filter("is_valid = 1").select(on, "image_id", "split", "class_name", "cleaned_path")
    valid.join(content, on).write.mode("overwrite").partitionBy("split", "class_name").parquet(path)


def append_run_log(rows: DataFrame, path: str) -> None:
    conform(rows, RUN_LOG).write.mode("append").partitionBy("experiment").parquet(path)


def metric_rows(metrics: DataFrame, experiment: str, run: str, step: str | None, ts: str) -> DataFrame:
    """Wide metric columns as run-log rows; `run`, `step` and `ts` name columns."""
    names = [c for c in metrics.columns if c not in {run, step, ts}]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names]
    )
    return metrics.select(
        F.lit(experiment).alias("experiment"),
        F.col(run).cast("string").alias("run_id"),
        F.lit("metric").alias("kind"),
        (F.col(step) if step else F.lit(0)).cast("bigint").alias("step"),
        F.col(ts).cast("bigint").alias("ts"),
        F.inline(pairs),
    )
