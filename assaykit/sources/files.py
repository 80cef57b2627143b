"""File sources: lists, index CSV, listings, pointer files, reports and images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaykit.functions import paths
from assaykit.functions.numeric import safe_round
from assaykit.schemas import INDEX, REPORT

# Fixed value: report CSV columns read by the ranking, with the name they get.
COMPARISON_COLUMNS = {
    "accuracy": "accuracy",
    "f1_weighted": "f1_weighted",
    "latency_mean_ms": "latency_mean_ms",
    "throughput_img_per_sec": "throughput_img_per_sec",
    "cost_per_1k_dkk": "cost_per_1k_images_dkk",
    "maintainability_score": "maintainability_score",
    "param_count_M": "param_count_M",
}
REPORT_DEFAULTS = {
    "accuracy": "quality.accuracy",
    "latency_mean_ms": "performance.latency_mean_ms",
    "cost_per_1k_dkk": "cost.cost_per_1k_images_dkk",
    "maintainability_score": "maintainability.maintainability_score",
}


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank trimmed lines with `line_no`, which grows in file order.

    The number is the partition and the place in it: splits of a file are read in offset order, so
    no single task has to count a whole list. `line_no >> 33` is the split, the natural block for
    counters.
    """
    return (
        spark.read.text(path)
        .withColumn("line_no", F.monotonically_increasing_id())
        .withColumn("value", F.regexp_replace("value", r"^\s+|\s+$", ""))
        .filter(F.length("value") > 0)
    )


def index_csv(spark: SparkSession, path: str, schema: T.StructType = INDEX) -> DataFrame:
    """Header CSV under a declared schema; values that do not parse become null."""
    return spark.read.schema(schema).option("header", True).csv(path)


def comparison_csv(spark: SparkSession, path: str, version_tag: str) -> DataFrame:
    """A comparison table read as text and typed tolerantly, with its row position."""
    raw = spark.read.option("header", True).csv(path)
    return typed_comparison(raw, version_tag)


def typed_comparison(raw: DataFrame, version_tag: str) -> DataFrame:
    have = set(raw.columns)
    own_tag = F.nullif("version_tag", F.lit("")) if "version_tag" in have else F.lit(None)
    position = "position" if "position" in have else F.monotonically_increasing_id()
    return raw.select(
        "model",
        F.coalesce(own_tag.cast("string"), F.lit(version_tag)).alias("version_tag"),
        *[
            (safe_round(F.col(c)) if c in have else F.lit(None).cast("double")).alias(name)
            for c, name in COMPARISON_COLUMNS.items()
        ],
        (F.col(position) if isinstance(position, str) else position).alias("position"),
    )


def file_listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, name, size, modified) of every file below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def latest_artifact(listing: DataFrame, preferred: str) -> DataFrame:
    """The preferred file when it is there, else the newest."""
    return (
        listing.withColumn("is_preferred", (F.col("name") == preferred).cast("int"))
        .orderBy(F.desc("is_preferred"), F.desc("modified"), F.asc("name"))
        .limit(1)
    )


def count_images(listing: DataFrame, column: str = "path") -> DataFrame:
    """One row: files with an image suffix, in any case."""
    name = paths.basename(F.col(column))
    return listing.agg(
        F.count_if(paths.suffix_lower(name).isin(paths.IMAGE_SUFFIXES)).alias("n_images")
    )


def model_files(listing: DataFrame) -> DataFrame:
    """Weight files by name, with the model and tag their names carry."""
    return (
        listing.filter(F.col("name").endswith(".pt"))
        .select(
            F.col("name").alias("weight_file"),
            paths.artifact_model(F.col("name")).alias("model_name"),
            paths.artifact_tag(F.col("name")).alias("version_tag"),
        )
        .orderBy("weight_file")
    )


def pointer_md5(text: DataFrame, column: str = "value") -> DataFrame:
    """First digest of a pointer file held whole in `column`; null when there is none."""
    # Fixed value: the pattern of a digest line.
    found = F.regexp_extract(column, r"md5:\s*([a-fA-F0-9]+)", 1)
    return text.withColumn("md5", F.nullif(found, F.lit("")))


def read_pointers(spark: SparkSession, path: str) -> DataFrame:
    """Pointer files are a few lines each, so each is read whole into one row."""
    whole = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1).alias("name"), "value"
    )
    return pointer_md5(whole).select("name", "md5")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).option("multiLine", True).json(path)


def report_meta(reports: DataFrame) -> DataFrame:
    """The four figures a model list shows, one row per report."""
    return reports.select(
        F.col("model").alias("model_name"),
        "version_tag",
        *[F.col(c).alias(name) for name, c in REPORT_DEFAULTS.items()],
    )


def parse_reports(texts: DataFrame, column: str = "value") -> DataFrame:
    """Report documents held as text; an unparsable one gives nulls."""
    parsed = F.from_json(F.col(column), REPORT, {"mode": "PERMISSIVE"})
    return texts.withColumn("report", parsed)


def with_report_meta(artifacts: DataFrame, meta: DataFrame) -> DataFrame:
    """Artifacts with their report figures, 0.0 where a report or a figure is missing."""
    joined = artifacts.join(meta, ["model_name", "version_tag"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in REPORT_DEFAULTS})


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images with their size in bytes and digest.

    Undecodable files stay as rows. The two scans meet on the path, which is unique.
    """
    decoded = (
        spark.read.format("image")
        .option("recursiveFileLookup", True)
        .option("dropInvalid", False)
        .load(path)
        .select("image", F.col("image.origin").alias("path"))
    )
    stored = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.regexp_replace("path", "^file:/+", "file:///").alias("path"),
            F.col("length").alias("file_size_bytes"),
            F.md5("content").alias("md5"),
            F.substring("content", 1, 12).alias("head"),
        )
    )
    return stored.join(
        decoded.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///")), "path", "left"
    )
