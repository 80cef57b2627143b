"""Validation: issue flags, scores, duplicate resolution, validity and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.functions import quality
from assaykit.functions.numeric import half_even
from assaykit.operators import duplicates
from assaykit.operators.skew import ROWS_PER_TASK
from assaykit.schemas import VALIDATION, conform

# Issue column -> flag, score columns, counted flags and report columns.
ISSUE_FLAGS = {
    "is_blurry_issue": "is_blurry",
    "is_dark_issue": "too_dark",
    "is_light_issue": "too_bright",
    "is_low_information_issue": "low_information",
    "is_odd_aspect_ratio_issue": "odd_aspect_ratio",
    "is_odd_size_issue": "odd_size",
    "is_exact_duplicates_issue": "is_exact_duplicate",
    "is_near_duplicates_issue": "is_near_duplicate",
}
SCORES = [
    "blurry_score",
    "dark_score",
    "light_score",
    "low_information_score",
    "odd_aspect_ratio_score",
    "odd_size_score",
    "exact_duplicates_score",
    "near_duplicates_score",
]
SUMMARY_FLAGS = {
    "corrupt_images": "is_corrupt",
    "blurry_images": "is_blurry",
    "too_dark_images": "too_dark",
    "too_bright_images": "too_bright",
    "low_information_images": "low_information",
    "odd_aspect_ratio_images": "odd_aspect_ratio",
    "odd_size_images": "odd_size",
    "exact_duplicate_images": "is_exact_duplicate",
    "near_duplicate_images": "is_near_duplicate",
}
GROUPED_FLAGS = {
    "valid_images": "is_valid",
    "blurry_images": "is_blurry",
    "dark_images": "too_dark",
    "bright_images": "too_bright",
    "low_information_images": "low_information",
    "odd_aspect_ratio_images": "odd_aspect_ratio",
    "odd_size_images": "odd_size",
    "exact_duplicate_images": "is_exact_duplicate",
    "near_duplicate_images": "is_near_duplicate",
    "corrupt_images": "is_corrupt",
}
DUPLICATE_REPORT = [
    "image_id",
    "duplicate_of",
    "canonical_image_id",
    "duplicate_distance",
    "raw_path",
    "class_name",
    "split",
    "cross_split_duplicate",
    "cross_class_duplicate",
    "manual_review_required",
    "drop_reason",
]
HELPERS = [*ISSUE_FLAGS, "relative_file", "split_priority", "width", "height"]


def init_rows(index: DataFrame, stamp: str) -> DataFrame:
    """One row per indexed item: flags 0, score 0, no links."""
    carried = {"image_id", "raw_path", "split", "class_name"}
    blank = {"is_corrupt"} | set(ISSUE_FLAGS.values())
    blank |= {"cross_split_duplicate", "cross_class_duplicate", "manual_review_required", "is_valid"}
    columns = []
    for field in VALIDATION.fields:
        if field.name in carried:
            columns.append(F.col(field.name))
        elif field.name in blank:
            columns.append(F.lit(0).alias(field.name))
        elif field.name == "quality_score":
            columns.append(F.lit(0.0).alias(field.name))
        elif field.name == "validation_timestamp":
            columns.append(F.lit(stamp).alias(field.name))
        elif field.name not in SCORES:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return index.select(*columns, "width", "height")


def join_issues(rows: DataFrame, issues: DataFrame, on: str) -> DataFrame:
    """Left join on the path key, keeping the issue columns that are there. Both sides hold each
    key once (see integrity.one_to_one)."""
    wanted = [on, *[c for c in (*ISSUE_FLAGS, *SCORES, "is_corrupt_issue") if c in issues.columns]]
    return rows.join(issues.select(*wanted), on, "left")


def flags_from_issues(df: DataFrame) -> DataFrame:
    """0/1 flags from the issue columns; unknown is 0, an absent column keeps the old flag."""
    columns = {"is_corrupt_issue": "is_corrupt", **ISSUE_FLAGS}
    return df.withColumns(
        {to: quality.flag(F.col(c)) for c, to in columns.items() if c in df.columns}
    )


def default_scores(df: DataFrame) -> DataFrame:
    """Absent score columns become null doubles."""
    return df.withColumns(
        {c: F.lit(None).cast("double") for c in SCORES if c not in df.columns}
    )


def assess(index: DataFrame, issues: DataFrame, on: str, stamp: str) -> DataFrame:
    """Index rows with flags and quality score, before duplicates are resolved."""
    rows = init_rows(index, stamp)
    flagged = default_scores(flags_from_issues(join_issues(rows, issues, on)))
    return flagged.withColumn("quality_score", quality.quality_score())


def resolve(
    rows: DataFrame,
    groups: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """Write the outcome of the duplicate groups into the rows. `total` is the number of membership
    rows where it is known."""
    members = duplicates.group_members(duplicates.union_groups(groups), rows)
    settled = duplicates.last_writer_wins(
        duplicates.resolve_in_groups(members, rows_per_task, total)
    ).withColumnRenamed("member", "image_id")
    links = ["canonical_image_id", "duplicate_of", "duplicate_distance", "drop_reason"]
    flags = ["cross_split_duplicate", "cross_class_duplicate", "manual_review_required"]
    joined = rows.drop(*links, *flags).join(settled, "image_id", "left")
    return joined.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0)) for c in flags},
            "is_exact_duplicate": F.greatest("is_exact_duplicate", F.coalesce("dup_exact", F.lit(0))),
            "is_near_duplicate": F.greatest("is_near_duplicate", F.coalesce("dup_near", F.lit(0))),
        }
    ).drop("dup_exact", "dup_near")


def decide(rows: DataFrame, cleaned_base: str) -> DataFrame:
    """Validity, and the target path of the rows that pass."""
    return rows.withColumn("is_valid", quality.is_valid()).withColumn(
        "cleaned_path", quality.cleaned_path(cleaned_base)
    )


def drop_helpers(rows: DataFrame) -> DataFrame:
    return rows.drop(*HELPERS)


def validate(
    index: DataFrame,
    issues: DataFrame,
    groups: DataFrame,
    on: str = "raw_path",
    stamp: str = "",
    cleaned_base: str = "data/cleaned",
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """The validation table of an index."""
    rows = assess(index, issues, on, stamp)
    return conform(decide(resolve(rows, groups, rows_per_task, total), cleaned_base), VALIDATION)


def validation_summary(table: DataFrame, odd_aspect: bool = True) -> DataFrame:
    """One row; sums are null, and the ratio too, when there are no rows. The form without
    odd-aspect counts rounds its ratio the way SQL does."""
    counted = {"valid_images": "is_valid", **SUMMARY_FLAGS}
    if not odd_aspect:
        counted.pop("odd_aspect_ratio_images")
    ratio = F.avg("is_valid")
    return table.agg(
        F.count("*").alias("total_images"),
        *[F.sum(c).alias(name) for name, c in counted.items()],
        (half_even(ratio, 4) if odd_aspect else F.round(ratio, 4)).alias("valid_ratio"),
    )


def validation_by_split_class(table: DataFrame) -> DataFrame:
    return (
        table.dropna(subset=["split", "class_name"])
        .groupBy("split", "class_name")
        .agg(
            F.count("image_id").alias("total_images"),
            *[F.sum(c).alias(name) for name, c in GROUPED_FLAGS.items()],
        )
        .orderBy("split", "class_name")
    )


def duplicate_report(table: DataFrame) -> DataFrame:
    touched = (
        (F.col("is_exact_duplicate") == 1)
        | (F.col("is_near_duplicate") == 1)
        | (F.col("manual_review_required") == 1)
        | F.col("duplicate_of").isNotNull()
    )
    return table.filter(touched).select(*DUPLICATE_REPORT)


def manifest(table: DataFrame, classes: list[str], version_tag: str | None = None) -> DataFrame:
    """Valid rows with a cleaned path in the listed classes, with their label. The tag is accepted
    and does not filter: the table holds one version."""
    from assaykit.operators.index import label_encode, selected_classes

    valid = table.filter("is_valid = 1 AND cleaned_path IS NOT NULL")
    return selected_classes(valid, classes).select(
        "image_id",
        "cleaned_path",
        "split",
        "class_name",
        label_encode(F.col("class_name"), classes).alias("label"),
    )


def records(
    table: DataFrame,
    split: str | None = None,
    class_name: str | None = None,
    is_valid: int | None = None,
) -> DataFrame:
    """Rows that match the filters that were given."""
    for column, wanted in (("split", split), ("class_name", class_name), ("is_valid", is_valid)):
        if wanted is not None:
            table = table.filter(F.col(column) == F.lit(wanted))
    return table


def page(df: DataFrame, order: list[str], limit: int = 50, offset: int = 0) -> DataFrame:
    """One page of an ordered listing."""
    if not 1 <= limit <= 500 or offset < 0:
        raise ValueError("limit is 1 to 500, offset at least 0")
    return df.orderBy(*order).offset(offset).limit(limit)
