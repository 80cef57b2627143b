"""Exact percentiles without holding a group's values in one aggregation buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.operators.skew import attach


def exact_percentiles(
    df: DataFrame,
    key: str,
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    accuracy: int = 10_000,
) -> DataFrame:
    """Linearly interpolated percentiles per key.

    A quantile sketch, whose rank error is at most n/accuracy, brackets each wanted rank with room
    for the next one. Only the values inside the bracket (about 10n/accuracy of them, already grouped
    with their counts) are sorted; everything below is counted. A key with fewer than `accuracy` rows
    takes its whole range as the bracket. The ranks are exact, so the result does not depend on the
    sketch.
    """
    values = df.select(key, value).filter(F.col(value).isNotNull())
    margin = 5.0 / accuracy
    marks = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    brackets = values.groupBy(key).agg(
        F.percentile_approx(value, F.array(*[F.lit(m) for m in marks]), F.lit(accuracy)).alias("_m"),
        F.count("*").alias("_n"),
        F.min(value).alias("_least"),
        F.max(value).alias("_most"),
    )
    few = F.col("_n") < accuracy
    counted = values.groupBy(key, value).agg(F.count("*").alias("_c"))
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.when(few, F.col("_least")).otherwise(F.get("_m", F.lit(i))).alias("lo"),
                F.when(few, F.col("_most"))
                .otherwise(F.get("_m", F.lit(i + len(probs))))
                .alias("hi"),
                (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank"),
            )
            for i, p in enumerate(probs)
        ]
    )
    placed = (
        # a key has at most as many distinct values as rows, so `_n` bounds its share of `counted`
        attach(counted, brackets, key, F.col(value), size="_n")
        .withColumn("_w", F.explode(wanted))
        .filter(F.col(value) <= F.col("_w.hi"))
        .select(
            key,
            "_w.i",
            "_w.rank",
            # all values under the bracket share one row
            F.when(F.col(value) >= F.col("_w.lo"), F.col(value)).alias("_v"),
            "_c",
        )
        .groupBy(key, "i", "rank", "_v")
        .agg(F.sum("_c").alias("_c"))
    )
    upto = (
        Window.partitionBy(key, "i")
        .orderBy(F.asc_nulls_first("_v"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = placed.withColumn("_upto", F.sum("_c").over(upto))

    def at(rank):
        return F.min(F.when(F.col("_upto") > rank, F.col("_v")))

    points = ranked.groupBy(key, "i").agg(
        at(F.floor("rank")).alias("_a"),
        at(F.ceil("rank")).alias("_b"),
        F.first(F.col("rank") - F.floor("rank")).alias("_part"),
    )
    found = F.col("_a") * (1 - F.col("_part")) + F.col("_b") * F.col("_part")
    return points.groupBy(key).agg(
        *[F.max(F.when(F.col("i") == i, found)).alias(name) for i, name in enumerate(names)]
    )
