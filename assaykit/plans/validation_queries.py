"""Queries of the validation job: issues, duplicate groups, resolution, validity, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assaykit.functions import quality
from assaykit.operators import duplicates, similarity, validation
from assaykit.plans import bindings as b
from assaykit.plans.catalog import query
from assaykit.schemas import VALIDATION
from assaykit.session import cut
from assaykit.sources import tables

EXACT = "exact_groups"
BOTH = "all_groups"
CLEANED = "data/cleaned"


def assessed(stage: b.Stage):
    return validation.assess(stage.index, b.issues(stage.rows, stage.groups), "raw_path", b.STAMP)


def validated(spark, sf, *kinds: str):
    """The validation table under the groups of the given kinds."""
    stage = b.stage(spark, sf, *kinds)
    return validation.validate(
        stage.index,
        b.issues(stage.rows, stage.groups),
        stage.groups,
        stamp=b.STAMP,
        total=stage.members,
    )


def stored(spark, sf, *kinds: str):
    """The validation table as it is kept: written once, so that filters and columns of what reads it
    reach the files."""
    return cut(validated(spark, sf, *kinds))


def narrow_index(spark, sf):
    """Ids and digests, written once: the documents are scanned a single time."""
    return cut(b.image_index(spark, sf).select("image_id", "md5"))


def members(stage: b.Stage):
    return duplicates.group_members(duplicates.union_groups(stage.groups), assessed(stage))


def resolved(spark, sf, *kinds: str):
    stage = b.stage(spark, sf, *kinds)
    return duplicates.resolve_in_groups(members(stage), total=stage.members)


# --- issues and flags --------------------------------------------------------------------------

ISSUE_COLUMNS = [
    "image_id",
    "is_blurry_issue",
    "is_dark_issue",
    "is_light_issue",
    "is_low_information_issue",
    "is_exact_duplicates_issue",
    "light_score",
]


@query(
    "join_issues_left_1to1",
    """SELECT image_id, CAST(blurry AS INTEGER) AS is_blurry_issue,
        CAST(dark AS INTEGER) AS is_dark_issue, CAST(bright AS INTEGER) AS is_light_issue,
        CAST(lowinfo AS INTEGER) AS is_low_information_issue,
        CASE WHEN exact_size IS NOT NULL THEN 1 END AS is_exact_duplicates_issue,
        round(1 - digit_share, 6) AS light_score FROM issues""",
    ("issues",),
    groups=EXACT,
)
def join_issues_left_1to1(spark, sf):
    stage = b.stage(spark, sf)
    rows = validation.init_rows(stage.index, b.STAMP)
    joined = validation.join_issues(rows, b.issues(stage.rows, stage.groups), "raw_path")
    return joined.select(
        *[
            F.col(c).cast("int").alias(c) if c.endswith("_issue") else F.col(c)
            for c in ISSUE_COLUMNS
        ]
    )


@query(
    "flags_from_issues",
    """SELECT image_id, is_corrupt, is_blurry, too_dark, too_bright, low_information,
        odd_aspect_ratio, 0 AS odd_size,
        CASE WHEN exact_size IS NOT NULL THEN 1 ELSE 0 END AS is_exact_duplicate, 0 AS is_near_duplicate
    FROM assessed""",
    ("assessed",),
    groups=EXACT,
)
def flags_from_issues(spark, sf):
    flags = ["is_corrupt", *validation.ISSUE_FLAGS.values()]
    return assessed(b.stage(spark, sf)).select("image_id", *flags)


@query(
    "default_missing_scores",
    """SELECT image_id, CAST(1 - toxic AS DOUBLE) AS blurry_score, CAST(quality AS DOUBLE) AS dark_score,
        round(1 - digit_share, 6) AS light_score, round(height / width, 6) AS low_information_score,
        aspect_ratio AS odd_aspect_ratio_score, CAST(NULL AS DOUBLE) AS odd_size_score,
        round(1.0 / exact_size, 6) AS exact_duplicates_score,
        CAST(NULL AS DOUBLE) AS near_duplicates_score FROM issues""",
    ("issues",),
    groups=EXACT,
)
def default_missing_scores(spark, sf):
    return assessed(b.stage(spark, sf)).select("image_id", *validation.SCORES)


@query(
    "quality_score",
    "SELECT image_id, CAST(quality_score AS DOUBLE) AS quality_score FROM assessed",
    ("assessed",),
    groups=EXACT,
)
def quality_score(spark, sf):
    return assessed(b.stage(spark, sf)).select("image_id", "quality_score")


@query(
    "init_validation_row",
    """SELECT image_id, raw_path, split, class_name, 0 AS is_corrupt, 0 AS is_valid,
        CAST(0 AS DOUBLE) AS quality_score, CAST(NULL AS VARCHAR) AS duplicate_of,
        CAST(NULL AS DOUBLE) AS duplicate_distance, ingestion_timestamp AS validation_timestamp
    FROM idx""",
    ("idx",),
)
def init_validation_row(spark, sf):
    return validation.init_rows(b.image_index(spark, sf), b.STAMP).select(
        "image_id",
        "raw_path",
        "split",
        "class_name",
        "is_corrupt",
        "is_valid",
        "quality_score",
        "duplicate_of",
        "duplicate_distance",
        "validation_timestamp",
    )


@query(
    "drop_helper_columns",
    """SELECT image_id, raw_path, split, class_name, is_corrupt, is_blurry, too_dark, too_bright,
        low_information, CAST(quality_score AS DOUBLE) AS quality_score FROM assessed""",
    ("assessed",),
    groups=EXACT,
)
def drop_helper_columns(spark, sf):
    wanted = [
        "image_id",
        "raw_path",
        "split",
        "class_name",
        "is_corrupt",
        "is_blurry",
        "too_dark",
        "too_bright",
        "low_information",
        "quality_score",
    ]
    bare = validation.drop_helpers(assessed(b.stage(spark, sf)))
    assert not set(bare.columns) & set(validation.HELPERS)
    return bare.select(*wanted)


@query(
    "evolve_schema",
    """SELECT image_id, split, CAST(NULL AS VARCHAR) AS drop_reason, CAST(NULL AS INTEGER) AS is_valid
    FROM idx WHERE split = 'train'
    UNION ALL SELECT image_id, split, 'old' AS drop_reason, 1 FROM idx WHERE split = 'test'""",
    ("idx",),
)
def evolve_schema(spark, sf):
    rows = b.image_index(spark, sf).select("image_id", "split")
    old = rows.filter("split = 'test'").withColumns(
        {"drop_reason": F.lit("old"), "is_valid": F.lit(1)}
    )
    both = tables.append_evolving(rows.filter("split = 'train'"), old, VALIDATION)
    return both.select("image_id", "split", "drop_reason", "is_valid")


# --- duplicate groups --------------------------------------------------------------------------


@query(
    "exact_duplicate_groups",
    "SELECT group_id, member, group_size FROM exact_groups",
    ("exact_groups",),
)
def exact_duplicate_groups(spark, sf):
    index = narrow_index(spark, sf)
    groups = duplicates.exact_groups(index, total=index.count())
    return groups.select("group_id", "member", "group_size")


@query(
    "near_duplicate_groups",
    "SELECT group_id, member, group_size FROM near_groups",
    ("near_groups",),
)
def near_duplicate_groups(spark, sf):
    return b.stage(spark, sf, "near").groups.select("group_id", "member", "group_size")


RECALL = 0.9


@query(
    "near_duplicate_lsh",
    """SELECT count(*) AS exact_members, count(DISTINCT group_id) AS exact_groups, CAST(0 AS BIGINT) AS false_links,
        TRUE AS recall_reached FROM near_groups""",
    ("near_groups",),
)
def near_duplicate_lsh(spark, sf):
    """The approximate search beside the exact one: members of exact groups, links between different
    exact groups (there are none), and whether RECALL of the members are found, in groups that hold as
    much of their exact one."""
    rows = cut(b.doc_rows(spark, sf))
    docs = tables.spread(tables.parquet(spark, sf, "documents"))
    total = rows.count()
    sets = cut(similarity.distinct_sets(docs, "doc_id", "text"))
    exact = cut(duplicates.near_groups(docs, rows, total=total, sets=sets)).select("member", F.col("group_id").alias("exact"), F.col("group_size").alias("whole"))
    found = duplicates.near_groups(docs, rows, approximate=True, total=total, sets=sets).select("member", "group_id", "group_size")
    both = cut(exact.join(found, "member", "full"))
    mixed = both.filter("group_id IS NOT NULL").groupBy("group_id").agg(
        (F.count_if(F.col("exact").isNull()) + F.count_distinct("exact") - 1).alias("wrong")
    )
    facts = both.agg(
        F.count("exact").alias("exact_members"),
        F.count_distinct("exact").alias("exact_groups"),
        F.sum(F.coalesce(F.try_divide("group_size", "whole"), F.lit(0.0))).alias("held"),
    )
    return facts.crossJoin(mixed.agg(F.coalesce(F.sum("wrong"), F.lit(0)).alias("false_links"))).select(  # one row each
        "exact_members",
        "exact_groups",
        "false_links",
        (F.col("held") >= RECALL * F.col("exact_members")).alias("recall_reached"),
    )


@query(
    "union_tagged_groups",
    "SELECT kind, group_id, member FROM all_groups",
    ("all_groups",),
    groups=BOTH,
)
def union_tagged_groups(spark, sf):
    groups = b.stage(spark, sf, "exact", "near").groups
    parts = [groups.filter(F.col("kind") == kind) for kind in duplicates.KIND_ORDER]
    return duplicates.union_groups(*parts).select("kind", "group_id", "member")


@query(
    "distinct_members",
    "SELECT DISTINCT group_id, member FROM exact_groups",
    ("exact_groups",),
)
def distinct_members(spark, sf):
    index = narrow_index(spark, sf)
    groups = duplicates.exact_groups(index, total=index.count()).select("group_id", "member")
    return duplicates.distinct_members(groups.unionByName(groups))


@query(
    "join_members_to_rows",
    """SELECT g.group_id, a.image_id AS member, a.split, a.class_name, a.width, a.height,
        CAST(a.quality_score AS DOUBLE) AS quality_score
    FROM exact_groups g JOIN assessed a ON a.image_id = g.member""",
    ("assessed", "exact_groups"),
    groups=EXACT,
)
def join_members_to_rows(spark, sf):
    return members(b.stage(spark, sf)).select(
        "group_id", "member", "split", "class_name", "width", "height", "quality_score"
    )


@query(
    "filter_group_size",
    """SELECT group_id, count(*) AS known_members FROM exact_groups g JOIN idx i
        ON i.image_id = g.member WHERE i.split = 'train' GROUP BY group_id HAVING count(*) > 1""",
    ("idx", "exact_groups"),
)
def filter_group_size(spark, sf):
    # only training rows are known here, so some groups shrink to one member and drop out
    stage = b.stage(spark, sf)
    rows = assessed(stage).filter("split = 'train'")
    known = duplicates.group_members(duplicates.union_groups(stage.groups), rows)
    return duplicates.group_facts(known).select("group_id", "known_members")


@query(
    "group_facts",
    """SELECT DISTINCT group_id, CAST(has_train AS INTEGER) AS has_train,
        CAST(same_split AS INTEGER) AS same_split, CAST(same_class AS INTEGER) AS same_class,
        CAST(NOT same_class AS INTEGER) AS cross_class FROM placed""",
    ("placed",),
    groups=EXACT,
)
def group_facts(spark, sf):
    facts = duplicates.group_facts(members(b.stage(spark, sf)))
    names = ["has_train", "same_split", "same_class", "cross_class"]
    return facts.select("group_id", *[F.col(c).cast("int").alias(c) for c in names])


@query(
    "choose_canonical",
    "SELECT DISTINCT group_id, canonical_image_id FROM placed",
    ("placed",),
    groups=EXACT,
)
def choose_canonical(spark, sf):
    return duplicates.group_facts(members(b.stage(spark, sf))).select("group_id", "canonical_image_id")


@query(
    "assign_canonical",
    "SELECT image_id, canonical_image_id FROM settled",
    ("settled",),
    groups=EXACT,
)
def assign_canonical(spark, sf):
    return duplicates.last_writer_wins(resolved(spark, sf)).select(
        F.col("member").alias("image_id"), "canonical_image_id"
    )


@query(
    "join_canonical_self",
    """SELECT group_id, image_id AS member, cross_split_duplicate, cross_class_duplicate FROM resolved
    WHERE is_other""",
    ("resolved",),
    groups=EXACT,
)
def join_canonical_self(spark, sf):
    return resolved(spark, sf).filter("is_other").select(
        "group_id", "member", "cross_split_duplicate", "cross_class_duplicate"
    )


@query(
    "drop_reason",
    "SELECT group_id, image_id AS member, drop_reason FROM resolved WHERE is_other",
    ("resolved",),
    groups=EXACT,
)
def drop_reason(spark, sf):
    return resolved(spark, sf).filter("is_other").select("group_id", "member", "drop_reason")


SETTLED = """SELECT image_id, canonical_image_id, duplicate_of, duplicate_distance,
    cross_split_duplicate, cross_class_duplicate, manual_review_required, drop_reason, dup_exact,
    dup_near FROM settled"""


def _settled(spark, sf):
    settled = duplicates.last_writer_wins(resolved(spark, sf, "exact", "near"))
    return settled.withColumnRenamed("member", "image_id")


@query("last_writer_wins", SETTLED, ("settled",), groups=BOTH)
def last_writer_wins(spark, sf):
    return _settled(spark, sf)


@query(
    "resolve_duplicates",
    """SELECT group_id, kind, image_id AS member, duplicate_of, duplicate_distance,
        cross_split_duplicate, cross_class_duplicate, drop_reason FROM resolved""",
    ("resolved",),
    groups=BOTH,
)
def resolve_duplicates(spark, sf):
    return resolved(spark, sf, "exact", "near").select(
        "group_id",
        "kind",
        "member",
        "duplicate_of",
        "duplicate_distance",
        "cross_split_duplicate",
        "cross_class_duplicate",
        "drop_reason",
    )


@query(
    "duplicate_distance",
    """SELECT image_id, duplicate_distance FROM settled WHERE duplicate_of IS NOT NULL""",
    ("settled",),
    groups=BOTH,
)
def duplicate_distance(spark, sf):
    return (
        _settled(spark, sf)
        .filter(F.col("duplicate_of").isNotNull())
        .select("image_id", "duplicate_distance")
    )


# --- validity and reports ----------------------------------------------------------------------


@query(
    "is_valid",
    "SELECT image_id, is_valid, drop_reason FROM validated",
    ("validated",),
    groups=EXACT,
)
def is_valid(spark, sf):
    return validated(spark, sf).select("image_id", "is_valid", "drop_reason")


@query(
    "cleaned_path",
    "SELECT image_id, cleaned_path FROM validated",
    ("validated",),
    groups=EXACT,
)
def cleaned_path(spark, sf):
    return validated(spark, sf).select("image_id", "cleaned_path")


@query(
    "scan_validation_table",
    """SELECT image_id, raw_path, cleaned_path, split, class_name, is_corrupt, is_blurry, too_dark,
        too_bright, low_information, is_exact_duplicate, is_near_duplicate, duplicate_of,
        canonical_image_id, CAST(quality_score AS DOUBLE) AS quality_score, is_valid, drop_reason
    FROM validated""",
    ("validated",),
    groups=EXACT,
)
def scan_validation_table(spark, sf):
    return validated(spark, sf).select(
        "image_id",
        "raw_path",
        "cleaned_path",
        "split",
        "class_name",
        "is_corrupt",
        "is_blurry",
        "too_dark",
        "too_bright",
        "low_information",
        "is_exact_duplicate",
        "is_near_duplicate",
        "duplicate_of",
        "canonical_image_id",
        "quality_score",
        "is_valid",
        "drop_reason",
    )


def _sums(columns: dict[str, str]) -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {name}" for name, c in columns.items())


@query(
    "validation_summary",
    f"""SELECT count(*) AS total_images, CAST(sum(is_valid) AS BIGINT) AS valid_images,
        {_sums(validation.SUMMARY_FLAGS)}, pround(avg(is_valid), 4) AS valid_ratio FROM validated""",
    ("validated",),
    groups=EXACT,
)
def validation_summary(spark, sf):
    return validation.validation_summary(validated(spark, sf))


@query(
    "api_validation_summary",
    "SELECT count(*) AS total_images, CAST(sum(is_valid) AS BIGINT) AS valid_images, "
    + _sums(
        {k: v for k, v in validation.SUMMARY_FLAGS.items() if k != "odd_aspect_ratio_images"}
    )
    + ", round(avg(CAST(is_valid AS DOUBLE)), 4) AS valid_ratio FROM validated",
    ("validated",),
    groups=EXACT,
)
def api_validation_summary(spark, sf):
    return validation.validation_summary(validated(spark, sf), odd_aspect=False)


@query(
    "validation_by_split_class",
    f"""SELECT split, class_name, count(image_id) AS total_images, {_sums(validation.GROUPED_FLAGS)}
    FROM validated GROUP BY split, class_name ORDER BY split, class_name""",
    ("validated",),
    groups=BOTH,
)
def validation_by_split_class(spark, sf):
    """The whole job: index, exact and near groups, resolution, validity, report."""
    table = validated(spark, sf, "exact", "near")
    return validation.validation_by_split_class(table)


@query(
    "filter_duplicate_report",
    """SELECT image_id FROM validated WHERE is_exact_duplicate = 1 OR is_near_duplicate = 1
        OR manual_review_required = 1 OR duplicate_of IS NOT NULL""",
    ("validated",),
    groups=EXACT,
)
def filter_duplicate_report(spark, sf):
    return validation.duplicate_report(validated(spark, sf)).select("image_id")


@query(
    "duplicate_report",
    f"""SELECT {', '.join(validation.DUPLICATE_REPORT)} FROM validated WHERE is_exact_duplicate = 1
        OR is_near_duplicate = 1 OR manual_review_required = 1 OR duplicate_of IS NOT NULL""",
    ("validated",),
    groups=BOTH,
)
def duplicate_report(spark, sf):
    return validation.duplicate_report(validated(spark, sf, "exact", "near"))


MANIFEST_SQL = """SELECT image_id, cleaned_path, split, class_name, label_id AS label FROM validated
    WHERE is_valid = 1 AND cleaned_path IS NOT NULL AND class_name IN ('c0', 'c1', 'c2', 'c3')"""


@query("load_manifest", MANIFEST_SQL, ("validated",), groups=EXACT)
def load_manifest(spark, sf):
    return validation.manifest(stored(spark, sf), b.CLASSES[:4], "cleaned_v1")


@query(
    "filter_valid_with_path",
    "SELECT image_id, cleaned_path FROM validated WHERE is_valid = 1 AND cleaned_path IS NOT NULL",
    ("validated",),
    groups=EXACT,
)
def filter_valid_with_path(spark, sf):
    return (
        stored(spark, sf)
        .filter("is_valid = 1 AND cleaned_path IS NOT NULL")
        .select("image_id", "cleaned_path")
    )


@query(
    "point_lookup",
    """SELECT image_id, is_valid, drop_reason FROM validated
    WHERE image_id = (SELECT max(image_id) FROM idx)""",
    ("validated", "idx"),
    groups=EXACT,
)
def point_lookup(spark, sf):
    wanted = b.image_index(spark, sf).agg(F.max("image_id")).first()[0]
    table = stored(spark, sf).filter(F.col("image_id") == wanted)
    return table.select("image_id", "is_valid", "drop_reason")


@query(
    "dynamic_conjunction",
    """SELECT image_id, split, class_name, is_valid FROM validated WHERE split = 'train'
        AND is_valid = 1""",
    ("validated",),
    groups=EXACT,
)
def dynamic_conjunction(spark, sf):
    return validation.records(stored(spark, sf), split="train", is_valid=1).select(
        "image_id", "split", "class_name", "is_valid"
    )


@query(
    "publish_cleaned",
    """SELECT v.split, v.class_name, count(*) AS n,
        CAST(sum(octet_length(encode(d.text))) AS BIGINT) AS content_bytes, min(v.cleaned_path) AS first_path
    FROM validated v JOIN documents d ON d.doc_id = v.doc_id WHERE v.is_valid = 1 GROUP BY 1, 2""",
    ("validated",),
    groups=EXACT,
)
def publish_cleaned(spark, sf):
    from assaykit.session import scratch_path
    from assaykit.sources import sinks

    content = b.doc_rows(spark, sf).select("raw_path", F.col("counter").alias("doc_id")).join(
        tables.parquet(spark, sf, "documents").select("doc_id", F.col("text").alias("content")),
        "doc_id",
    )
    path = scratch_path(spark, "cleaned")
    sinks.publish_cleaned(validated(spark, sf), content, "raw_path", path)
    return (
        spark.read.parquet(path)
        .groupBy("split", "class_name")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.octet_length("content")).alias("content_bytes"),
            F.min("cleaned_path").alias("first_path"),
        )
    )


@query(
    "refresh_table",
    f"""SELECT count(*) AS total_images, CAST(sum(is_valid) AS BIGINT) AS valid_images FROM validated""",
    ("validated",),
    groups=EXACT,
)
def refresh_table(spark, sf):
    """The managed table made empty, filled, and replaced once more, then read by its name."""
    name = f"image_validation_results_{uuid.uuid4().hex[:12]}"
    tables.create_if_missing(spark, name, VALIDATION)
    table = stored(spark, sf)
    tables.refresh(table.filter("is_valid = 1"), name, VALIDATION)
    tables.refresh(table, name, VALIDATION)
    return spark.table(name).agg(
        F.count("*").alias("total_images"), F.sum("is_valid").alias("valid_images")
    )


@query(
    "publish_view",
    """SELECT CAST(sum(is_valid) AS BIGINT) AS first_rows, CAST(sum(is_valid) AS BIGINT) AS held_rows,
        count(*) AS total_images, CAST(2 AS BIGINT) AS versions FROM validated""",
    ("validated",),
    groups=EXACT,
)
def publish_view(spark, sf):
    """A view published three times: what a reader of the second state sees before the third, and after
    it, holding on; then the last state by name. Two tables stay behind the view."""
    name = f"image_validation_{uuid.uuid4().hex[:12]}"
    table = stored(spark, sf)
    tables.publish(table.limit(0), name, VALIDATION)
    tables.publish(table.filter("is_valid = 1"), name, VALIDATION)
    held = spark.table(name)
    first = held.count()
    tables.publish(table, name, VALIDATION)
    return spark.table(name).agg(F.count("*").alias("total_images")).select(
        F.lit(first).cast("long").alias("first_rows"),
        F.lit(held.count()).cast("long").alias("held_rows"),
        "total_images",
        F.lit(len(tables.versions_of(spark, name))).cast("long").alias("versions"),
    )


@query(
    "evolve_stored_table",
    """SELECT split, count(*) AS n, count(class_name) AS classed FROM (
        SELECT split, CAST(NULL AS VARCHAR) AS class_name FROM idx WHERE split = 'train'
        UNION ALL SELECT split, class_name FROM idx WHERE split = 'test') GROUP BY split""",
    ("idx",),
)
def evolve_stored_table(spark, sf):
    """A stored table with old files that lack most columns: they are added, new rows come with them,
    old ones read as nulls."""
    name = f"image_validation_old_{uuid.uuid4().hex[:12]}"
    rows = b.image_index(spark, sf)
    rows.filter("split = 'train'").select("image_id", "split").write.format("parquet").saveAsTable(name)
    added = tables.evolve_table(spark, name, VALIDATION)
    assert added and not tables.evolve_table(spark, name, VALIDATION)
    have = spark.table(name).columns
    new = tables.evolve(rows.filter("split = 'test'").select("image_id", "split", "class_name"), VALIDATION)
    new.select(*have).write.insertInto(name)
    return spark.table(name).groupBy("split").agg(F.count("*").alias("n"), F.count("class_name").alias("classed"))
