"""Parquet tables and tables kept by the catalog."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaykit.schemas import conform, empty, missing_columns


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer splits than there are cores, which happens only
    with few or unsplittable files; any larger input is left as it is. For work that is heavy per
    row, such as cutting up whole texts."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the declared columns it lacks, as typed nulls; others stay."""
    lacking = set(missing_columns(df, schema))
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name in lacking}
    )


def append_evolving(old: DataFrame, new: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of both in the declared shape, whichever columns each has."""
    return conform(old.unionByName(new, allowMissingColumns=True), schema)


def create_if_missing(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    """Make an empty managed table of the declared shape; False when it is there already."""
    if spark.catalog.tableExists(table):
        return False
    empty(spark, schema).write.format("parquet").saveAsTable(table)
    return True


def refresh(df: DataFrame, table: str, schema: T.StructType) -> None:
    """Replace the content of a managed table by this frame, in its declared shape."""
    conform(df, schema).write.mode("overwrite").format("parquet").saveAsTable(table)


def evolve_table(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the declared columns that a stored table lacks, and return their names. Its files stay as
    they are; rows written before have nulls there."""
    lacking = missing_columns(spark.table(table), schema)
    if lacking:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name in set(lacking))
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    return lacking


def versions_of(spark: SparkSession, view: str) -> list[str]:
    """The stored tables behind a published view, oldest first."""
    database, _, name = view.rpartition(".")
    listed = spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''} LIKE '{name}__v*'").collect()
    prefix = f"{database}." if database else ""
    return sorted(f"{prefix}{r['tableName']}" for r in listed if not r["isTemporary"])


def publish(df: DataFrame, view: str, schema: T.StructType, keep: int = 2) -> str:
    """Give a view new content without a moment in which it is missing or empty, and return the name of
    the table behind it.

    The frame is written, in its declared shape, as a table of its own; then the view is pointed at it
    in one step of the catalog. So a reader sees the old rows or the new ones, and a failed write leaves
    the old ones in place. The last `keep` tables stay, so that a reader who resolved the view before the
    swap can finish; older ones are dropped. Names are ordered by time; two writers at once both succeed
    and the later swap stands.
    """
    spark = df.sparkSession
    table = f"{view}__v{time.time_ns():020d}"
    conform(df, schema).write.format("parquet").saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    for old in versions_of(spark, view)[: -max(1, keep)]:
        if old != table:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return table
