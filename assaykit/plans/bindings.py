"""The test tables in the roles the operators expect. Each role has the same definition in SQL in
`oracle.py`."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.functions import letters, quality
from assaykit.functions.numeric import half_even, softmax
from assaykit.operators import duplicates
from assaykit.operators.index import enrich, name_items
from assaykit.schemas import INDEX
from assaykit.session import cut
from assaykit.sources.tables import parquet, spread

CLASSES = ["c0", "c1", "c2", "c3", "c4"]
SPLITS = ["train", "test"]
SUFFIXES = [".de", ".en", ".es", ".fr"]
RAW_ROOT = "data/raw"
STAMP = "2026-01-01T00:00:00.000000"
PRED_CLASSES = [f"k{i}" for i in range(10)]
METRIC_OF = {
    "click": "final_accuracy",
    "view": "latency_mean_ms",
    "purchase": "cost_per_1k_images_dkk",
    "signup": "maintainability_score",
    "error": "trainable_params",
}


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as listed files: split, class and the path they are listed under."""
    number = F.substring("source", 4, 10).cast("int")
    group = F.floor(F.col("doc_id") / 20)
    return (
        parquet(spark, sf, "documents")
        .withColumn("split", F.when(group % 5 == 0, "test").otherwise("train"))
        .withColumn("class_name", F.concat(F.lit("c"), (number % 5).cast("string")))
        .withColumn(
            "original_relative_path",
            F.concat(
                F.col("class_name"),
                F.lit("/"),
                F.col("source"),
                F.lit("_"),
                F.col("doc_id").cast("string"),
                F.lit("."),
                F.upper("lang"),
            ),
        )
    )


def doc_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Index columns plus the facts the issue flags come from. Texts are reduced to their facts in the
    scan; what is joined is narrow. Labels are one row per document, so that the optimizer drops the
    join where no label column is asked for."""
    words = F.split("text", " ")
    length = F.length("text")
    digits = length - F.length(F.translate("text", "0123456789", ""))
    # an empty text's share is 0/0, in SQL not a number and above any limit; Spark's division is an error
    share = F.when(length == 0, F.lit(float("nan"))).otherwise(digits / length)
    docs = listing(spark, sf).select(
        "doc_id",
        "split",
        "class_name",
        "original_relative_path",
        "lang",
        F.size(words).alias("width"),
        F.size(F.array_distinct(words)).alias("height"),
        F.octet_length("text").cast("bigint").alias("file_size_bytes"),
        F.md5("text").alias("md5"),
        share.alias("digit_share"),
    )
    labels = (
        parquet(spark, sf, "labels")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    facts = docs.join(labels, "doc_id", "left").select(
        "doc_id",
        "split",
        "class_name",
        "original_relative_path",
        F.col("doc_id").alias("counter"),
        F.lit("documents").alias("source_dataset"),
        "width",
        "height",
        F.when(F.col("quality") == 1, 3).when(F.col("quality") == 0, 1).alias("channels"),
        F.when(F.col("quality") == 1, "RGB").when(F.col("quality") == 0, "L").alias("image_mode"),
        F.col("lang").alias("image_format"),
        F.lit(0).alias("exif_tag_count"),
        "file_size_bytes",
        "md5",
        F.lit(STAMP).alias("ingestion_timestamp"),
        "digit_share",
        "quality",
        "toxic",
    )
    return name_items(facts, CLASSES, RAW_ROOT).withColumns(
        {
            "aspect_ratio": quality.aspect_ratio(F.col("width"), F.col("height")),
            "pixel_count": quality.pixel_count(F.col("width"), F.col("height")),
        }
    )


def image_index(spark: SparkSession, sf: str) -> DataFrame:
    return doc_rows(spark, sf).select(*INDEX.fieldNames())


def master(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(image_index(spark, sf))


def issues(rows: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Issue flags and scores by path; the content flags are null where the document is unlabelled.
    There is no odd-size column. With `groups`, every member of a group is flagged."""
    labelled = F.col("quality").isNotNull()
    low = F.col("height") / F.col("width")
    out = rows.select(
        "raw_path",
        "image_id",
        F.when(labelled, F.col("file_size_bytes") < 64).alias("is_corrupt_issue"),
        F.when(labelled, F.col("toxic") == 1).alias("is_blurry_issue"),
        F.when(labelled, F.col("quality") == 0).alias("is_dark_issue"),
        F.when(labelled, F.col("digit_share") > 0.02).alias("is_light_issue"),
        F.when(labelled, low < 0.35).alias("is_low_information_issue"),
        (~F.col("aspect_ratio").between(0.4, 2.5)).alias("is_odd_aspect_ratio_issue"),
        (1 - F.col("toxic")).cast("double").alias("blurry_score"),
        F.col("quality").cast("double").alias("dark_score"),
        F.round(1 - F.col("digit_share"), 6).alias("light_score"),
        F.round(low, 6).alias("low_information_score"),
        F.col("aspect_ratio").alias("odd_aspect_ratio_score"),
    )
    if groups is None:
        return out
    marks = []
    for kind in duplicates.KIND_ORDER:
        size = F.max(F.when(F.col("kind") == kind, F.col("group_size")))
        marks += [
            size.isNotNull().alias(f"is_{kind}_duplicates_issue"),
            F.round(1.0 / size, 6).alias(f"{kind}_duplicates_score"),
        ]
    flagged = groups.groupBy(F.col("member").alias("image_id")).agg(*marks)
    return out.join(flagged, "image_id", "left")


@dataclass
class Stage:
    """Index rows and duplicate groups, written once for all that reads them."""

    rows: DataFrame
    index: DataFrame
    groups: DataFrame
    members: int


def stage(spark: SparkSession, sf: str, *kinds: str) -> Stage:
    """The index of `sf` with its groups of the given kinds: exact, near or near_lsh."""
    rows = cut(doc_rows(spark, sf))
    total = rows.count()
    index = rows.select(*INDEX.fieldNames())
    groups = None
    for kind in kinds or ("exact",):
        if kind == "exact":
            found = duplicates.exact_groups(index, total=total)
        else:
            found = duplicates.near_groups(
                spread(parquet(spark, sf, "documents")), rows, approximate=kind == "near_lsh", total=total
            )
        groups = found if groups is None else groups.unionByName(found)
    groups = cut(groups)
    return Stage(rows, index, groups, groups.count())


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(model, item, label, logits, probs): the first ten dimensions as logits."""
    logits = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    return (
        parquet(spark, sf, "embeddings")
        .select(
            F.concat(F.lit("m"), (F.col("vec_id") % 3).cast("string")).alias("model"),
            F.col("vec_id").alias("item"),
            "label",
            logits.alias("logits"),
        )
        .withColumn("probs", softmax(F.col("logits")))
        .withColumn(
            "pred", (F.array_position("logits", F.array_max("logits")) - 1).cast("int")
        )
    )


def batches(spark: SparkSession, sf: str) -> DataFrame:
    return parquet(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.col("l_linenumber").alias("epoch"),
        F.when(F.col("l_linestatus") == "O", "train").otherwise("val").alias("phase"),
        F.col("l_discount").alias("loss"),
        F.col("l_quantity").alias("n"),
        (F.col("l_quantity") * (1 - F.col("l_tax"))).alias("correct"),
        F.col("l_orderkey").cast("double").alias("begin_s"),
        (F.col("l_orderkey") + F.col("l_quantity")).alias("end_s"),
    )


def tensors(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_suppkey") % 7
    return parquet(spark, sf, "lineitem").select(
        F.concat(F.lit("net"), line.cast("string")).alias("model"),
        (F.col("l_quantity") * 10 * (line + 1)).alias("numel"),
        (F.col("l_linestatus") == "O").alias("trainable"),
    )


def epochs(spark: SparkSession, sf: str) -> DataFrame:
    """(model, epoch, acc): one row per event type and day."""
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) + 1
    return (
        parquet(spark, sf, "events")
        .groupBy(F.col("event_type").alias("model"), day.alias("epoch"))
        .agg(F.round(F.avg("value") / 100, 4).alias("acc"))
    )


def event_millis():
    """Milliseconds since 1970 of a zone-less timestamp, whatever the session time zone is."""
    ts = F.col("ts")
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return days * 86_400_000 + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000 + seconds


def _user_events(spark: SparkSession, sf: str) -> DataFrame:
    return parquet(spark, sf, "events").select(
        F.concat(F.lit("exp"), (F.col("user_id") % 3).cast("string")).alias("experiment"),
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        "user_id",
        "event_id",
        "event_type",
        event_millis().alias("ts"),
        "value",
    )


def run_meta(spark: SparkSession, sf: str) -> DataFrame:
    """One row per user: its run and when it started."""
    return (
        _user_events(spark, sf)
        .groupBy("experiment", "run_id", "user_id")
        .agg(F.min("ts").alias("start_time"))
        .select(
            "experiment",
            "run_id",
            F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string"), F.lit("_"), "run_id").alias(
                "run_name"
            ),
            F.lit("FINISHED").alias("status"),
            "start_time",
            F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("model"),
            F.concat(F.lit("cleaned_v"), (F.col("user_id") % 2).cast("string")).alias("tag"),
        )
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as metric lines of the run of their user, and two parameters per run."""
    key = F.create_map(*[F.lit(x) for pair in METRIC_OF.items() for x in pair])
    metrics = _user_events(spark, sf).select(
        "experiment",
        "run_id",
        F.lit("metric").alias("kind"),
        key[F.col("event_type")].alias("key"),
        F.col("event_id").alias("step"),
        "ts",
        F.col("value").cast("string").alias("value"),
    )
    pairs = F.array(
        F.struct(F.lit("model").alias("key"), F.col("model").alias("value")),
        F.struct(F.lit("dataset_version_tag").alias("key"), F.col("tag").alias("value")),
    )
    params = run_meta(spark, sf).select(
        "experiment",
        "run_id",
        F.lit("param").alias("kind"),
        F.inline(pairs),
    ).select(
        "experiment",
        "run_id",
        "kind",
        "key",
        F.lit(0).cast("bigint").alias("step"),
        F.lit(None).cast("bigint").alias("ts"),
        "value",
    )
    return metrics.unionByName(params)


def experiments(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _user_events(spark, sf)
        .select("experiment", F.concat(F.lit("name_"), "experiment").alias("name"))
        .distinct()
    )


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """One candidate per brand. Every seventh has no accuracy, every eleventh a latency of zero."""
    part = parquet(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    line = parquet(spark, sf, "lineitem").select(
        "l_partkey", "l_discount", "l_tax", "l_quantity", "l_extendedprice"
    )
    # one row per part goes into the join
    per_part = line.groupBy("l_partkey").agg(
        F.sum("l_discount").alias("d"),
        F.sum("l_tax").alias("t"),
        F.sum("l_quantity").alias("q"),
        F.sum("l_extendedprice").alias("e"),
        F.count("*").alias("n"),
    )
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    n = F.sum("n")
    return (
        part.join(per_part, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy("p_brand")
        .agg(
            F.round(1 - F.sum("d") / n, 4).alias("accuracy"),
            F.round(1 - F.sum("t") / n, 4).alias("f1_weighted"),
            F.round(F.sum("q") / n, 4).alias("latency_mean_ms"),
            F.round(F.sum(F.col("p_size") * F.col("n")) / n / 4, 3).alias("param_count_M"),
            F.round(F.sum("e") / n / 1000, 4).alias("cost_per_1k_images_dkk"),
            F.round(F.sum(F.col("p_size") * F.col("n")) / n / 10, 4).alias("maintainability_score"),
        )
        .withColumn("position", number)
        .select(
            F.when(F.col("position") % 2 == 0, "even").otherwise("odd").alias("comparison_id"),
            F.col("p_brand").alias("model"),
            F.lit("cleaned_v1").alias("version_tag"),
            F.when(F.col("position") % 7 != 0, F.col("accuracy")).alias("accuracy"),
            F.when(F.col("position") % 11 == 0, 0.0)
            .otherwise(F.col("latency_mean_ms"))
            .alias("latency_mean_ms"),
            "cost_per_1k_images_dkk",
            "maintainability_score",
            "position",
            "f1_weighted",
            half_even(F.try_divide(F.lit(1000.0), F.col("latency_mean_ms")), 1).alias(
                "throughput_img_per_sec"
            ),
            "param_count_M",
        )
    )


def version_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as version records in the order they were written."""
    return parquet(spark, sf, "orders").select(
        F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("version_tag"),
        (F.col("o_orderkey") % 1000).cast("bigint").alias("raw_image_count"),
        (F.col("o_custkey") % 1000).cast("bigint").alias("cleaned_image_count"),
        F.when(F.col("o_custkey") % 3 != 0, F.md5(F.col("o_orderkey").cast("string"))).alias(
            "git_commit"
        ),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("created_at"),
        F.col("o_custkey").cast("string").alias("notes"),
        "o_orderkey",
        F.struct(
            F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("d"), "o_orderkey"
        ).alias("written"),
    )


def urls(spark: SparkSession, sf: str) -> DataFrame:
    return parquet(spark, sf, "pages").select("page_id", "url")


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Weight file names, one per user and event type that user has."""
    name = F.concat(
        "event_type",
        F.lit("_"),
        (F.col("user_id") % 5).cast("string"),
        F.when(F.col("user_id") % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit("_cleaned_v"), (F.col("user_id") % 3).cast("string"))
        ),
        F.lit(".pt"),
    )
    return parquet(spark, sf, "events").select(name.alias("name")).distinct()


def derived_images(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as 8×8 grey images in the layout of the image source; those of label 9 are made
    undecodable."""
    byte = F.transform(
        "embedding",
        lambda x: F.lpad(
            F.hex(F.least(F.greatest(F.floor((x + 0.5) * 255), F.lit(0)), F.lit(255))), 2, "0"
        ),
    )
    data = F.unhex(F.array_join(byte, ""))
    good = F.col("label") != 9
    origin = F.format_string("images/%06d.png", F.col("vec_id"))
    side = F.when(good, 8).otherwise(-1)
    return parquet(spark, sf, "embeddings").select(
        origin.alias("path"),
        "vec_id",
        F.when(good, F.unhex(F.lit("89504E470D0A1A0A"))).otherwise(F.unhex(F.lit("00"))).alias("head"),
        F.struct(
            origin.alias("origin"),
            side.alias("height"),
            side.alias("width"),
            F.when(good, 1).otherwise(-1).alias("nChannels"),
            F.lit(0).alias("mode"),
            data.alias("data"),
        ).alias("image"),
    )


LANGS = ["de", "en", "es", "fr"]
LETTERS = "abcdefghijklmnopqrstuvwxyzäßçéèñóü"


def letter_shares(spark: SparkSession, sf: str) -> DataFrame:
    """(item, label, embedding): documents in a known language, by how often each letter stands in them."""
    shares = letters.shares(F.coalesce("text", F.lit("")), LETTERS)
    langs = F.array(*[F.lit(c) for c in LANGS])
    return (
        parquet(spark, sf, "documents")
        .filter(F.col("lang").isin(LANGS) & F.col("text").isNotNull())
        .select(F.col("doc_id").alias("item"), (F.array_position(langs, F.col("lang")) - 1).cast("int").alias("label"), shares.alias("embedding"))
    )
