"""Checks that return the offending rows; an empty result means the rule holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def missing_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that are not unique on their side."""
    return (
        repeated_keys(left, key)
        .withColumn("side", F.lit("left"))
        .unionByName(repeated_keys(right, key).withColumn("side", F.lit("right")))
    )


def row_count_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: both counts, the keys only one side has, and whether the counts agree."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = tagged.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.count_if(F.col("r") == 0).alias("only_left"),
        F.count_if(F.col("l") == 0).alias("only_right"),
    ).withColumn("matches", (F.col("left_rows") == F.col("right_rows")).cast("int"))


def nulls_in(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.col(c).isNull()
    return df.filter(hit)


def out_of_bounds(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Values outside [low, high] and missing ones."""
    return df.filter(F.col(column).isNull() | ~F.col(column).between(low, high))


def readiness(df: DataFrame) -> DataFrame:
    """One row: 'ok' when the table has at least one row, else 'degraded'."""
    return df.limit(1).agg(
        F.when(F.count("*") > 0, "ok").otherwise("degraded").alias("status")
    )


def check_metrics(not_null: Sequence[str], bounds: dict[str, tuple[float, float]]) -> list[Column]:
    """Counts of rows, of rows with a null among `not_null`, and of values outside their bounds or
    missing, by column."""
    hit = F.lit(False)
    for c in not_null:
        hit = hit | F.col(c).isNull()
    outside = [
        F.count_if(F.col(c).isNull() | ~F.col(c).between(low, high)).alias(f"out_of_bounds_{c}")
        for c, (low, high) in bounds.items()
    ]
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_nulls"), *outside]


def write_checked(
    df: DataFrame, path: str, not_null: Sequence[str] = (), bounds: dict[str, tuple[float, float]] | None = None
) -> dict[str, int]:
    """Write a frame as Parquet and return its checks, counted while it is written, so that they cost no
    scan. A stage that ran again after a lost executor may have been counted twice; so the rows counted
    are held against those in the files' footers, and the written table is counted where they differ."""
    metrics = check_metrics(not_null, bounds or {})
    seen = Observation()
    df.observe(seen, *metrics).write.parquet(path)
    found = dict(seen.get)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if written.count() != found["n_rows"]:
        found = written.agg(*metrics).first().asDict()
    return found
