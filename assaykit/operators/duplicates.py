"""Duplicate groups: membership rows, canonical choice and resolution of overlapping groups.

A group is never an array: it is a set of membership rows (group_id, kind, member), and everything
known about it comes from mergeable aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.functions import quality
from assaykit.operators.similarity import (
    near_duplicate_components,
    near_duplicate_lsh_components,
)
from assaykit.operators.skew import ROWS_PER_TASK, attach

# Exact groups are applied before near ones, later ones overwrite.
KIND_ORDER = {"exact": 0, "near": 1}


def repeated_content(index: DataFrame, key: str = "md5") -> DataFrame:
    """(key, group_size, first_member) for content held more than once."""
    return (
        index.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("group_size"), F.min("image_id").alias("first_member"))
        .filter("group_size > 1")
    )


def exact_groups(
    index: DataFrame,
    key: str = "md5",
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """(group_id, kind, member, group_size): rows with identical content. `total` is the row count
    of the index where it is known."""
    facts = repeated_content(index, key)
    rows = index.select(key, F.col("image_id").alias("member"))
    return attach(
        rows,
        facts,
        key,
        F.col("member"),
        size="group_size",
        rows_per_task=rows_per_task,
        total=total,
    ).select(
        F.concat(F.lit("exact:"), "first_member").alias("group_id"),
        F.lit("exact").alias("kind"),
        "member",
        "group_size",
    )


def near_groups(
    docs: DataFrame,
    index: DataFrame,
    threshold: float = 0.8,
    approximate: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
    sets: DataFrame | None = None,
) -> DataFrame:
    """(group_id, kind, member, group_size): rows connected by near-identical content.

    Copies of one text alone are an exact group, not a near one; a near group joins at least two
    different texts and lists every copy of them. `index` names the row behind each document by
    doc_id and md5. `sets` are the documents' written similarity.distinct_sets, where they are there.
    """
    find = near_duplicate_lsh_components if approximate else near_duplicate_components
    linked = find(docs, threshold=threshold, rows_per_task=rows_per_task, sets=sets)
    members = attach(
        index.select("md5", F.col("image_id").alias("member")),
        linked.select(F.col("content").alias("md5"), "component"),
        "md5",
        F.col("member"),
        rows_per_task=rows_per_task,
        total=total,
    )
    sizes = members.groupBy("component").agg(
        F.count("*").alias("group_size"), F.min("member").alias("first_member")
    )
    return attach(
        members,
        sizes,
        "component",
        F.col("member"),
        size="group_size",
        rows_per_task=rows_per_task,
        total=total,
    ).select(
        F.concat(F.lit("near:"), "first_member").alias("group_id"),
        F.lit("near").alias("kind"),
        "member",
        "group_size",
    )


def union_groups(*groups: DataFrame) -> DataFrame:
    """All membership rows with the order in which their groups are applied."""
    columns = ["group_id", "kind", "member"]
    out = groups[0].select(*columns)
    for other in groups[1:]:
        out = out.unionByName(other.select(*columns))
    rank = F.lit(None).cast("int")
    for kind, place in KIND_ORDER.items():
        rank = F.when(F.col("kind") == kind, place).otherwise(rank)
    return out.withColumn("seq", F.struct(rank.alias("kind_rank"), F.col("group_id")))


def distinct_members(groups: DataFrame) -> DataFrame:
    return groups.distinct()


def group_members(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Members that are known rows, each once per group, with the columns that decide about them."""
    known = rows.select(
        F.col("image_id").alias("member"),
        "split",
        "class_name",
        "width",
        "height",
        "quality_score",
        "near_duplicates_score",
    )
    return groups.distinct().join(known, "member")


def group_facts(members: DataFrame) -> DataFrame:
    """Per group: size, canonical member and what its members have in common.

    Nulls count as one more value. Groups with a single known member are left out.
    """

    def descending(name: str):
        # unknown values come after all known ones
        return [F.col(name).isNull(), -F.col(name)]

    best = F.min(
        F.struct(
            (-quality.split_priority(F.col("split"))).alias("p"),
            *[c.alias(f"q{i}") for i, c in enumerate(descending("quality_score"))],
            *[c.alias(f"w{i}") for i, c in enumerate(descending("width"))],
            *[c.alias(f"h{i}") for i, c in enumerate(descending("height"))],
            F.col("member"),
            F.col("split").alias("canonical_split"),
            F.col("class_name").alias("canonical_class"),
        )
    )

    def single(name: str):
        kinds = F.struct(F.col(name))
        return F.min(kinds) == F.max(kinds)

    return (
        members.groupBy("group_id", "kind", "seq")
        .agg(
            F.count("*").alias("known_members"),
            best.alias("_best"),
            F.max(F.coalesce(F.col("split") == "train", F.lit(False))).alias("has_train"),
            single("split").alias("same_split"),
            single("class_name").alias("same_class"),
        )
        .filter("known_members > 1")
        .select(
            "group_id",
            "kind",
            "seq",
            "known_members",
            F.col("_best.member").alias("canonical_image_id"),
            F.col("_best.canonical_split").alias("canonical_split"),
            F.col("_best.canonical_class").alias("canonical_class"),
            "has_train",
            "same_split",
            "same_class",
            (~F.col("same_class")).alias("cross_class"),
        )
    )


def resolve_in_groups(
    members: DataFrame, rows_per_task: int = ROWS_PER_TASK, total: int | None = None
) -> DataFrame:
    """One row per (group, member): its canonical item and, for the others, why and how it goes.
    `total` bounds the number of members where it is known."""
    facts = group_facts(members)
    joined = attach(
        members.drop("kind", "seq"),
        facts,
        "group_id",
        F.col("member"),
        size="known_members",
        rows_per_task=rows_per_task,
        total=total,
    )
    other = F.col("member") != F.col("canonical_image_id")
    reason = quality.drop_reason(
        F.col("split"), F.col("has_train"), F.col("same_split"), F.col("same_class")
    )

    def differs(a: str, b: str):
        return (~F.col(a).eqNullSafe(F.col(b))).cast("int")

    return joined.select(
        "group_id",
        "kind",
        "seq",
        "member",
        "canonical_image_id",
        other.alias("is_other"),
        F.when(other, F.col("canonical_image_id")).alias("duplicate_of"),
        F.when(
            other,
            F.when(
                F.col("kind") == "near", F.coalesce("near_duplicates_score", F.lit(0.0))
            ).otherwise(0.0),
        ).alias("duplicate_distance"),
        F.when(other, differs("split", "canonical_split")).alias("cross_split_duplicate"),
        F.when(other, differs("class_name", "canonical_class")).alias("cross_class_duplicate"),
        F.when(other, reason).alias("drop_reason"),
    )


def last_writer_wins(resolved: DataFrame) -> DataFrame:
    """One row per member over all its groups.

    The canonical id is that of the last group. The other attributes come from the last group in
    which the row was not canonical. Flags, once set, stay.
    """
    other = F.col("is_other")

    def last(name: str):
        return F.max_by(F.when(other, F.col(name)), F.when(other, F.col("seq"))).alias(name)

    def ever(condition):
        return F.max(F.coalesce(other & condition, F.lit(False)).cast("int"))

    return resolved.groupBy("member").agg(
        F.max_by("canonical_image_id", "seq").alias("canonical_image_id"),
        last("duplicate_of"),
        last("duplicate_distance"),
        last("cross_split_duplicate"),
        last("cross_class_duplicate"),
        last("drop_reason"),
        ever(F.col("drop_reason") == quality.KEEP_CROSS).alias("manual_review_required"),
        ever(F.col("kind") == "exact").alias("dup_exact"),
        ever(F.col("kind") == "near").alias("dup_near"),
    )
