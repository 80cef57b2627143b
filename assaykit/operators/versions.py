"""Dataset version records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.operators.skew import blocked_row_number

BUCKET_DIGITS = 5
BRANCH_DIGITS = 2


def manifest_hash(entries: DataFrame) -> DataFrame:
    """One digest over (path, size, sha256) entries, whatever order they come in.

    A hash tree: entries fall into 16^5 buckets by the md5 of their path, each bucket is digested in
    path order, then 16^2 branches of bucket digests, then the root. Paths are unique, so the
    buckets stay even and no task sees more than its bucket.
    """
    line = F.concat_ws("|", "path", F.col("size").cast("string"), "sha256")
    leaves = (
        entries.select(
            F.substring(F.md5("path"), 1, BUCKET_DIGITS).alias("bucket"),
            F.struct("path", line.alias("line")).alias("e"),
        )
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list("e")).alias("es"))
        .select("bucket", _digest(F.col("es.line")).alias("digest"))
    )
    branches = (
        leaves.groupBy(F.substring("bucket", 1, BRANCH_DIGITS).alias("branch"))
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "digest"))).alias("ds"))
        .select("branch", _digest(F.col("ds.digest")).alias("digest"))
    )
    return branches.agg(
        F.sort_array(F.collect_list(F.struct("branch", "digest"))).alias("ds")
    ).select(_digest(F.col("ds.digest")).alias("manifest_sha256"))


def _digest(lines: Column) -> Column:
    return F.sha2(F.array_join(lines, "\n"), 256)


def version_record(
    tag: str,
    raw: DataFrame,
    cleaned: DataFrame,
    pointers: DataFrame,
    entries: DataFrame,
    commit: str | None,
    created_at: str,
    notes: str = "",
) -> DataFrame:
    """The record of a version: image counts, pointer digests, manifest digest and parameters.

    `raw` and `cleaned` are file listings with a path, `pointers` holds (name, md5) for raw,
    cleaned and reports. Every piece is one row, taken as a value.
    """
    from assaykit.sources.files import count_images

    def pointer(name: str) -> Column:
        return pointers.filter(F.col("name") == name).agg(F.first("md5").alias("md5")).scalar()

    base = manifest_hash(entries)
    return base.select(
        F.lit(tag).alias("version_tag"),
        count_images(raw).scalar().cast("bigint").alias("raw_image_count"),
        count_images(cleaned).scalar().cast("bigint").alias("cleaned_image_count"),
        pointer("raw").alias("raw_dvc_md5"),
        pointer("cleaned").alias("cleaned_dvc_md5"),
        pointer("reports").alias("reports_dvc_md5"),
        "manifest_sha256",
        F.lit(commit).cast("string").alias("git_commit"),
        F.lit(created_at).alias("created_at"),
        F.lit(notes).alias("notes"),
    )


def latest_per_tag(records: DataFrame, order: str) -> DataFrame:
    """The last record of each tag."""
    columns = [c for c in records.columns if c != "version_tag"]
    kept = records.groupBy("version_tag").agg(
        F.max_by(F.struct(*columns), F.col(order)).alias("r")
    )
    return kept.select("version_tag", *[F.col(f"r.{c}").alias(c) for c in columns])


def upsert_versions(
    existing: DataFrame, incoming: DataFrame, order: str, block: Column
) -> DataFrame:
    """Replace by tag. A replaced row is gone whole; every incoming record gets a new id above all
    ids given before. `incoming` holds each tag once."""
    top = existing.agg(F.coalesce(F.max("version_id"), F.lit(0)).alias("m")).scalar()
    numbered = blocked_row_number(incoming, [], block, [F.col(order)], "_nr")
    fresh = numbered.withColumn("version_id", (F.col("_nr") + top).cast("int")).drop("_nr")
    kept = existing.join(incoming.select("version_tag"), "version_tag", "left_anti")
    return kept.unionByName(fresh.select(*existing.columns))


def version_listing(versions: DataFrame) -> DataFrame:
    """Newest first, with the id under its public name."""
    return versions.select(
        F.col("version_id").alias("id"),
        "version_tag",
        "raw_image_count",
        "cleaned_image_count",
        "git_commit",
        "created_at",
        "notes",
    ).orderBy(F.desc("created_at"), F.desc("id"))


def version_by_tag(tags: DataFrame, versions: DataFrame) -> DataFrame:
    """The record of each asked tag; an unknown tag gets a default with commit 'unknown'."""
    return tags.join(versions, "version_tag", "left").withColumn(
        "git_commit",
        F.when(F.col("version_id").isNull(), F.lit("unknown")).otherwise(F.col("git_commit")),
    )
