"""Profile tables of an enriched index. Each is one partial + final aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.operators.quantiles import exact_percentiles

# The flag behind each anomaly count and the columns checked for nulls.
ANOMALIES = {
    "small_images": "is_small_image",
    "odd_aspect_images": "is_odd_aspect",
    "non_rgb_images": "is_non_rgb",
}
AVERAGES = {"avg_width": "width", "avg_height": "height", "avg_file_size_kb": "file_size_kb"}
NULL_CHECKED = ["width", "height", "channels", "image_mode", "image_format", "aspect_ratio", "md5"]


def class_summary(master: DataFrame) -> DataFrame:
    means = [F.round(F.avg(c), 1).alias(name) for name, c in AVERAGES.items()]
    return (
        master.groupBy("split", "class_name")
        .agg(F.count("*").alias("image_count"), *means)
        .orderBy("split", "class_name")
    )


def anomaly_counts(master: DataFrame, key: str) -> DataFrame:
    """Rows and flagged rows per value of one column."""
    flagged = [F.count_if(F.col(c) == 1).alias(name) for name, c in ANOMALIES.items()]
    return master.groupBy(key).agg(F.count("*").alias("total_images"), *flagged).orderBy(key)


def value_counts(df: DataFrame, key: str, keep_null: bool = True) -> DataFrame:
    """Count per value, largest first, ties by value."""
    source = df if keep_null else df.dropna(subset=[key])
    return (
        source.groupBy(key)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last(key))
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(*keys)


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Values held by more than one row."""
    return df.groupBy(key).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def null_summary(df: DataFrame, columns: Sequence[str] = tuple(NULL_CHECKED)) -> DataFrame:
    """One row of null counts; nulls, not zeros, for an empty frame."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in columns])


def count_matrix(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of `row` × `column` with a fixed column list, 0 where nothing falls."""
    return (
        df.dropna(subset=[row, column])
        .groupBy(row)
        .agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])
    )


def profile_cube(master: DataFrame) -> DataFrame:
    """Split, class and split × class counts from a single scan."""
    flagged = [F.count_if(F.col(c) == 1).alias(name) for name, c in ANOMALIES.items()]
    level = F.grouping_id("split", "class_name")
    return (
        master.groupingSets(
            [[F.col("split"), F.col("class_name")], [F.col("split")], [F.col("class_name")]],
            "split",
            "class_name",
        )
        .agg(level.alias("level"), F.count("*").alias("total_images"), *flagged)
        .select(
            F.when(F.col("level") == 0, "split_class")
            .when(F.col("level") == 1, "split")
            .otherwise("class")
            .alias("grain"),
            "split",
            "class_name",
            "total_images",
            *ANOMALIES,
        )
    )


def size_outliers(
    df: DataFrame, column: str, whiskers: float = 1.5, name: str = "odd_size"
) -> DataFrame:
    """Flag values outside the interquartile range, widened by `whiskers` times its length.

    The quartiles come back as single values, so nothing is joined.
    """
    quartiles = exact_percentiles(
        df.withColumn("_all", F.lit(1)), "_all", column, [0.25, 0.75], ["lo", "hi"]
    )
    reach = whiskers * (F.col("hi") - F.col("lo"))
    fences = quartiles.select(
        F.struct((F.col("lo") - reach).alias("low"), (F.col("hi") + reach).alias("high")).alias("f")
    ).scalar()
    outside = ~F.col(column).between(fences.getField("low"), fences.getField("high"))
    return df.withColumn(name, F.coalesce(outside, F.lit(False)).cast("int"))
