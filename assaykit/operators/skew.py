"""Joins and counters that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit.session import cut

ROWS_PER_TASK = 1_000_000
BROADCAST_KEYS = 100_000
NULL_SPREAD = 64


def hot_keys(counts: DataFrame, key: str, size: str, rows_per_task: int) -> DataFrame:
    """Every key with more rows than one task should take, with the number of copies it needs. There
    is at most one in `rows_per_task` rows, all of them are returned, and they are broadcast only where
    their counted number allows it; otherwise Spark joins them as it joins any table."""
    hot = cut(
        counts.filter((F.col(size) > rows_per_task) & F.col(key).isNotNull()).select(
            F.col(key).alias("_hot_key"),
            F.ceil(F.col(size) / F.lit(rows_per_task)).cast("int").alias("_copies"),
        )
    )
    return F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot


def attach(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    spread: Column,
    how: str = "inner",
    size: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """Join many rows per key with one fact row per key.

    `total` is a counted upper bound on `rows`; when it fits one task no key can be hot and the join
    is left as it is. Otherwise hot keys are split over several tasks by a salt taken from `spread`; their fact row is copied
    once per salt value. `size` names a fact column with the row count of the key; without it the
    counts are taken from `rows` (a pre-aggregated shuffle). Null keys, which match nothing, are
    spread too.
    """
    if total is not None and total <= rows_per_task:
        return rows.join(facts, key, how)
    counts = facts.select(key, size) if size else rows.groupBy(key).agg(F.count("*").alias("_size"))
    hot = hot_keys(counts, key, size or "_size", rows_per_task)
    salted = (
        rows.join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn(
            "_salt",
            F.pmod(
                F.xxhash64(spread),
                F.when(F.col(key).isNull(), F.lit(NULL_SPREAD)).otherwise(
                    F.coalesce("_copies", F.lit(1))
                ),
            ).cast("int"),
        )
        .drop("_hot_key", "_copies")
    )
    copied = (
        facts.join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
        .drop("_hot_key", "_copies")
    )
    return salted.join(copied, [key, "_salt"], how).drop("_salt")


def blocked_row_number(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[Column],
    name: str,
) -> DataFrame:
    """row_number per key, computed block by block.

    `block` must sort like a coarse form of `order` (ascending). Only one block of a key meets in a
    task: the block sizes are counted, their running sums give each block its offset, and rows are
    numbered inside the block. An unpartitioned window never sees more rows than there are blocks.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", block)
    sizes = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    before = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.col("_block").eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order))
    return (
        blocked.withColumn("_pos", inside)
        .join(offsets, same, "left")
        .withColumn(name, (F.col("_offset") + F.col("_pos")).cast("long"))
        .drop("_block", "_pos", "_offset", "_b", *[f"_k{i}" for i in range(len(keys))])
    )
