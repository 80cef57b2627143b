"""Building and enriching the item index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.functions import paths, quality
from assaykit.operators.skew import blocked_row_number

LINES_PER_BLOCK = 1_000_000


def label_encode(class_name: Column, classes: Sequence[str]) -> Column:
    """Dense id of a class in a fixed list, null when it is not listed."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.nullif(F.array_position(names, class_name), F.lit(0)).cast("int") - 1


def label_decode(label: Column, classes: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), label)


def selected_classes(df: DataFrame, classes: Sequence[str], column: str = "class_name") -> DataFrame:
    return df.filter(F.col(column).isin(list(classes)))


def only_listed(df: DataFrame, listing: DataFrame, on: str) -> DataFrame:
    """Rows whose file is in the listing."""
    return df.join(listing.select(on), on, "left_semi")


def not_listed(df: DataFrame, listing: DataFrame, on: str) -> DataFrame:
    """The report of rows without a file."""
    return df.join(listing.select(on), on, "left_anti")


def per_class_counter(
    df: DataFrame, order: str = "line_no", block: Column | None = None, name: str = "counter"
) -> DataFrame:
    """1-based running counter per split and class in list order, after all filters.

    The lines are numbered block by block, so a class with most of the rows is still counted by
    many tasks.
    """
    blocks = block if block is not None else F.floor(F.col(order) / LINES_PER_BLOCK)
    return blocked_row_number(df, ["split", "class_name"], blocks, [F.col(order)], name)


def name_items(df: DataFrame, classes: Sequence[str], raw_root: str) -> DataFrame:
    """Ids, file names and paths from split, class, counter and the listed path."""
    listed = F.col("original_relative_path")
    suffix = paths.suffix_lower(paths.basename(listed))
    return (
        df.withColumn("label_id", label_encode(F.col("class_name"), classes))
        .withColumn(
            "image_id", paths.item_id(F.col("split"), F.col("class_name"), F.col("counter"))
        )
        .withColumn("original_filename", paths.basename(listed))
        .withColumn(
            "new_filename", paths.item_filename(F.col("class_name"), F.col("counter"), suffix)
        )
        .withColumn(
            "raw_path", F.concat_ws("/", F.lit(raw_root), "split", "class_name", "new_filename")
        )
    )


def enrich(index: DataFrame) -> DataFrame:
    return index.select(
        "*",
        quality.file_size_kb(F.col("file_size_bytes")).alias("file_size_kb"),
        quality.is_small(F.col("width"), F.col("height")).alias("is_small_image"),
        quality.is_odd_aspect(F.col("aspect_ratio")).alias("is_odd_aspect"),
        quality.is_non_rgb(F.col("image_mode")).alias("is_non_rgb"),
    )


def integrity_flags(
    index: DataFrame,
    splits: Sequence[str],
    classes: Sequence[str],
    suffixes: Sequence[str],
) -> DataFrame:
    """Six checks of the stored columns; the definitions are this package's own."""
    size = F.col("file_size_bytes")
    missing = F.col("width").isNull() | F.col("height").isNull() | F.col("md5").isNull()

    def outside(value: Column, allowed: Sequence[str]) -> Column:
        return (~F.coalesce(value.isin(list(allowed)), F.lit(False))).cast("int")

    return index.select(
        "*",
        F.round(size / 1048576, 2).alias("file_size_mb"),
        missing.cast("int").alias("is_missing_core_metadata"),
        outside(F.col("split"), splits).alias("invalid_split"),
        outside(F.col("class_name"), classes).alias("invalid_class"),
        outside(paths.suffix_lower(F.col("new_filename")), suffixes).alias(
            "is_unexpected_extension"
        ),
        quality.flag(size <= 0).alias("is_zero_or_negative_size"),
    )
