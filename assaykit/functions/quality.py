"""Row rules for indexed items: flags, penalties and validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaykit.functions.numeric import half_even

# Thresholds, penalties and reason codes that results depend on.
MIN_SIDE = 256
MAX_ASPECT = 2.5
MIN_ASPECT = 0.4
PENALTIES = {
    "is_corrupt": 10.0,
    "is_blurry": 5.0,
    "too_dark": 2.5,
    "too_bright": 2.5,
    "low_information": 5.0,
}
TRAIN_ONLY_FLAGS = ["is_blurry", "too_dark", "too_bright", "low_information"]
DROP_TEST = "drop_test_duplicate_train_priority"
DROP_SAME = "drop_same_split_same_class_lower_quality"
KEEP_CROSS = "keep_cross_class_duplicate_same_split_manual_review"
DROP_OTHER = "drop_noncanonical_duplicate"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def file_size_kb(size: Column) -> Column:
    return F.round(size / 1024, 2)


def is_small(width: Column, height: Column) -> Column:
    return flag(F.least(width, height) < MIN_SIDE)


def is_odd_aspect(aspect: Column) -> Column:
    return flag(~aspect.between(MIN_ASPECT, MAX_ASPECT))


def is_non_rgb(mode: Column) -> Column:
    return flag(mode != "RGB")


def _both_sides(width: Column, height: Column) -> Column:
    return (width != 0) & (height != 0)


def aspect_ratio(width: Column, height: Column) -> Column:
    return F.when(_both_sides(width, height), half_even(width / height, 4))


def pixel_count(width: Column, height: Column) -> Column:
    return F.when(_both_sides(width, height), width.cast("bigint") * height)


def quality_score() -> Column:
    """Minus the weighted sum of the problem flags; an unknown flag costs nothing."""
    cost = F.lit(0.0)
    for name, weight in PENALTIES.items():
        cost = cost + F.coalesce(F.col(name), F.lit(0)) * F.lit(weight)
    # 0.0 - x rather than -x, so that a clean row scores 0.0 and not -0.0
    return F.lit(0.0) - cost


def split_priority(split: Column) -> Column:
    return flag(split == "train")


def drop_reason(
    split: Column, has_train: Column, same_split: Column, same_class: Column
) -> Column:
    return (
        F.when(has_train & (split == "test"), DROP_TEST)
        .when(same_split & same_class, DROP_SAME)
        .when(same_split, KEEP_CROSS)
        .otherwise(DROP_OTHER)
    )


def is_valid() -> Column:
    """Corrupt and dropped rows fail anywhere; the other flags fail training rows only."""
    bad_train = F.lit(False)
    for name in TRAIN_ONLY_FLAGS:
        bad_train = bad_train | F.coalesce(F.col(name) == 1, F.lit(False))
    dropped = F.coalesce(F.col("drop_reason").startswith("drop_"), F.lit(False))
    corrupt = F.coalesce(F.col("is_corrupt") == 1, F.lit(False))
    training = F.coalesce(F.col("split") == "train", F.lit(False))
    return (~(corrupt | dropped | (training & bad_train))).cast("int")


def cleaned_path(base: str) -> Column:
    name = F.split_part(F.col("raw_path"), F.lit("/"), F.lit(-1))
    target = F.concat_ws("/", F.lit(base), F.col("split"), F.col("class_name"), name)
    return F.when(F.col("is_valid") == 1, target)
