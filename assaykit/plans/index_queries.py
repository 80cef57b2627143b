"""Queries over the item index: expressions, filters, profile tables, counters, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaykit.functions import numeric, paths, quality
from assaykit.operators import index, integrity, profile, validation, versions
from assaykit.plans import bindings as b
from assaykit.plans.catalog import query
from assaykit.session import cut, scratch_path
from assaykit.sources import files, tables

IDX = ("idx",)
MASTER = ("master",)


@query(
    "scan_master_parquet",
    """SELECT image_id, split, class_name, width, height, aspect_ratio, file_size_kb, is_small_image,
        is_odd_aspect, is_non_rgb, md5 FROM master""",
    MASTER,
)
def scan_master_parquet(spark, sf):
    from assaykit.sources import sinks

    path = scratch_path(spark, "master")
    sinks.master_parquet(b.master(spark, sf), path)
    return spark.read.parquet(path).select(
        "image_id",
        "split",
        "class_name",
        "width",
        "height",
        "aspect_ratio",
        "file_size_kb",
        "is_small_image",
        "is_odd_aspect",
        "is_non_rgb",
        "md5",
    )


@query(
    "scan_images_table",
    "SELECT image_id, raw_path, split, class_name FROM idx ORDER BY split, class_name, image_id",
    IDX,
)
def scan_images_table(spark, sf):
    return (
        b.image_index(spark, sf)
        .select("image_id", "raw_path", "split", "class_name")
        .orderBy("split", "class_name", "image_id")
    )


# --- expressions -------------------------------------------------------------------------------


@query(
    "path_first_component",
    "SELECT page_id, split_part(url, '/', 1) AS first_part FROM pages",
)
def path_first_component(spark, sf):
    return b.urls(spark, sf).select(
        "page_id", paths.first_component(F.col("url")).alias("first_part")
    )


@query("path_basename", "SELECT page_id, split_part(url, '/', -1) AS base FROM pages")
def path_basename(spark, sf):
    return b.urls(spark, sf).select("page_id", paths.basename(F.col("url")).alias("base"))


@query(
    "path_suffix_lower",
    """SELECT page_id, lower(regexp_extract(split_part(url, '/', -1), '[^/](\\.[^./]+)$', 1)) AS suffix
    FROM pages""",
)
def path_suffix_lower(spark, sf):
    name = paths.basename(F.col("url"))
    return b.urls(spark, sf).select("page_id", paths.suffix_lower(name).alias("suffix"))


@query(
    "path_relative_to_root",
    """SELECT page_id, CASE WHEN starts_with(p, 'https:/') THEN substr(p, 8) ELSE p END AS relative
    FROM (SELECT page_id, replace(url, chr(92), '/') AS p FROM pages)""",
)
def path_relative_to_root(spark, sf):
    return b.urls(spark, sf).select(
        "page_id", paths.relative_to(F.col("url"), "https:/").alias("relative")
    )


@query(
    "label_encode",
    """SELECT image_id, CASE WHEN class_name IN ('c0','c1','c2','c3') THEN label_id END AS label,
        CASE WHEN class_name IN ('c0','c1','c2','c3') THEN class_name END AS decoded FROM idx""",
    IDX,
)
def label_encode(spark, sf):
    some = b.CLASSES[:4]
    coded = b.image_index(spark, sf).withColumn(
        "label", index.label_encode(F.col("class_name"), some)
    )
    return coded.select(
        "image_id", "label", index.label_decode(F.col("label"), some).alias("decoded")
    )


@query(
    "make_ids",
    "SELECT image_id, new_filename, raw_path, original_filename FROM idx",
    IDX,
)
def make_ids(spark, sf):
    return b.image_index(spark, sf).select(
        "image_id", "new_filename", "raw_path", "original_filename"
    )


@query(
    "coalesce_dims",
    """SELECT image_id, coalesce(CASE WHEN image_mode IS NOT NULL THEN width END, height) AS width
    FROM idx""",
    IDX,
)
def coalesce_dims(spark, sf):
    first = F.when(F.col("image_mode").isNotNull(), F.col("width"))
    return b.image_index(spark, sf).select(
        "image_id", F.coalesce(first, "height").alias("width")
    )


@query("aspect_ratio", "SELECT image_id, aspect_ratio FROM idx", IDX)
def aspect_ratio(spark, sf):
    return b.image_index(spark, sf).select("image_id", "aspect_ratio")


@query("pixel_count", "SELECT image_id, pixel_count FROM idx", IDX)
def pixel_count(spark, sf):
    return b.image_index(spark, sf).select("image_id", "pixel_count")


@query("content_md5", "SELECT doc_id, md5(text) AS md5 FROM documents")
def content_md5(spark, sf):
    return tables.parquet(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5"))


@query("content_sha256", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_sha256(spark, sf):
    return tables.parquet(spark, sf, "documents").select(
        "doc_id", F.sha2("text", 256).alias("sha256")
    )


@query("file_size", "SELECT image_id, file_size_bytes FROM idx", IDX)
def file_size(spark, sf):
    return b.image_index(spark, sf).select("image_id", "file_size_bytes")


@query("file_size_kb", "SELECT image_id, file_size_kb FROM master", MASTER)
def file_size_kb(spark, sf):
    return b.master(spark, sf).select("image_id", "file_size_kb")


@query("is_small_image", "SELECT image_id, is_small_image FROM master", MASTER)
def is_small_image(spark, sf):
    return b.master(spark, sf).select("image_id", "is_small_image")


@query("is_odd_aspect", "SELECT image_id, is_odd_aspect FROM master", MASTER)
def is_odd_aspect(spark, sf):
    return b.master(spark, sf).select("image_id", "is_odd_aspect")


@query("is_non_rgb", "SELECT image_id, is_non_rgb FROM master", MASTER)
def is_non_rgb(spark, sf):
    return b.master(spark, sf).select("image_id", "is_non_rgb")


@query("ingest_stamp", "SELECT image_id, TRUE AS well_formed, TRUE AS recent FROM idx", IDX)
def ingest_stamp(spark, sf):
    """Every row stamped with the time of the run; the stamp read back has the form and is of today."""
    stamped = b.image_index(spark, sf).select(
        "image_id",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("stamp"),
    )
    form = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$"
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(F.to_timestamp("stamp"))
    return stamped.select(
        "image_id", F.col("stamp").rlike(form).alias("well_formed"), age.between(0, 86_400).alias("recent")
    )


@query(
    "integrity_flags",
    """SELECT image_id, round(file_size_bytes / 1048576, 2) AS file_size_mb,
        CASE WHEN width IS NULL OR height IS NULL OR md5 IS NULL THEN 1 ELSE 0 END
            AS is_missing_core_metadata,
        CASE WHEN split IN ('train') THEN 0 ELSE 1 END AS invalid_split,
        CASE WHEN class_name IN ('c0', 'c1', 'c2') THEN 0 ELSE 1 END AS invalid_class,
        CASE WHEN image_format IN ('de', 'en') THEN 0 ELSE 1 END AS is_unexpected_extension,
        CASE WHEN file_size_bytes <= 0 THEN 1 ELSE 0 END AS is_zero_or_negative_size
    FROM idx""",
    IDX,
)
def integrity_flags(spark, sf):
    flagged = index.integrity_flags(
        b.image_index(spark, sf), ["train"], b.CLASSES[:3], [".de", ".en"]
    )
    return flagged.select(
        "image_id",
        "file_size_mb",
        "is_missing_core_metadata",
        "invalid_split",
        "invalid_class",
        "is_unexpected_extension",
        "is_zero_or_negative_size",
    )


@query(
    "split_priority",
    "SELECT image_id, CASE WHEN split = 'train' THEN 1 ELSE 0 END AS split_priority FROM idx",
    IDX,
)
def split_priority(spark, sf):
    return b.image_index(spark, sf).select(
        "image_id", quality.split_priority(F.col("split")).alias("split_priority")
    )


LAST_PART = "split_part(url, '/', -1)"


@query(
    "safe_round_float",
    f"""SELECT page_id, pround(try_cast(nullif({LAST_PART}, '') AS DOUBLE) / 7, 4) AS v
    FROM pages""",
)
def safe_round_float(spark, sf):
    # a seventh of the number, as text with many digits
    text = (numeric.safe_double(paths.basename(F.col("url"))) / 7).cast("string")
    return b.urls(spark, sf).select("page_id", numeric.safe_round(text).alias("v"))


@query(
    "safe_int",
    f"""SELECT page_id, CAST(trunc(try_cast(nullif({LAST_PART}, '') AS DOUBLE)) AS BIGINT) AS v
    FROM pages""",
)
def safe_int(spark, sf):
    return b.urls(spark, sf).select(
        "page_id", numeric.safe_long(paths.basename(F.col("url"))).alias("v")
    )


@query(
    "millis_to_iso",
    """SELECT event_id, replace(strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '')
        || '+00:00' AS iso FROM events""",
)
def millis_to_iso(spark, sf):
    return tables.parquet(spark, sf, "events").select(
        "event_id", numeric.millis_to_iso(b.event_millis()).alias("iso")
    )


@query(
    "parse_artifact_name",
    """SELECT name, CASE WHEN position('_cleaned' IN name) > 0
            THEN substr(name, 1, position('_cleaned' IN name) - 1)
            ELSE replace(name, '.pt', '') END AS model,
        CASE WHEN position('_cleaned' IN name) > 0
            THEN replace(substr(name, position('_cleaned' IN name) + 1), '.pt', '')
            ELSE 'unknown' END AS tag FROM arts""",
    ("arts",),
)
def parse_artifact_name(spark, sf):
    name = F.col("name")
    return b.artifacts(spark, sf).select(
        "name",
        paths.artifact_model(name).alias("model"),
        paths.artifact_tag(name).alias("tag"),
    )


@query(
    "tag_from_filename",
    """SELECT DISTINCT 'cleaned_v' || (o_custkey % 50) AS tag FROM orders""",
)
def tag_from_filename(spark, sf):
    name = F.concat(
        F.lit("model_comparison_cleaned_v"), (F.col("o_custkey") % 50).cast("string"), F.lit(".csv")
    )
    return (
        tables.parquet(spark, sf, "orders")
        .select(paths.tag_from_filename(name).alias("tag"))
        .distinct()
    )


@query(
    "score_bucket_1_5",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <= 3 THEN 5
        WHEN l_quantity <= 6 THEN 4 WHEN l_quantity <= 12 THEN 3 WHEN l_quantity <= 20 THEN 2
        ELSE 1 END AS score FROM lineitem""",
)
def score_bucket_1_5(spark, sf):
    return tables.parquet(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numeric.bucket_1_5(F.col("l_quantity"), (3.0, 6.0, 12.0, 20.0)).alias("score"),
    )


@query(
    "run_name",
    """SELECT event_id, event_type || '_cleaned_v1_' || strftime(ts, '%Y%m%d_%H%M%S') AS run_name
    FROM events""",
)
def run_name(spark, sf):
    return tables.parquet(spark, sf, "events").select(
        "event_id",
        paths.run_name(F.col("event_type"), F.lit("cleaned_v1"), F.col("ts")).alias("run_name"),
    )


# --- filters -----------------------------------------------------------------------------------


@query(
    "filter_selected_classes",
    "SELECT image_id, class_name FROM idx WHERE class_name IN ('c1', 'c3')",
    IDX,
)
def filter_selected_classes(spark, sf):
    return index.selected_classes(b.image_index(spark, sf), ["c1", "c3"]).select(
        "image_id", "class_name"
    )


@query(
    "filter_existing_files",
    "SELECT doc_id, original_relative_path FROM idx WHERE doc_id IN (SELECT doc_id FROM labels)",
    IDX,
)
def filter_existing_files(spark, sf):
    listed = b.listing(spark, sf).select("doc_id", "original_relative_path")
    return index.only_listed(listed, tables.parquet(spark, sf, "labels"), "doc_id")


@query(
    "join_listing_semi_anti",
    """SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'found' ELSE 'missing' END
        AS state FROM documents""",
)
def join_listing_semi_anti(spark, sf):
    listed = tables.parquet(spark, sf, "documents").select("doc_id")
    there = tables.parquet(spark, sf, "labels")
    found = index.only_listed(listed, there, "doc_id").withColumn("state", F.lit("found"))
    missing = index.not_listed(listed, there, "doc_id").withColumn("state", F.lit("missing"))
    return found.unionByName(missing)


@query("filter_split", "SELECT image_id, split FROM idx WHERE split = 'test'", IDX)
def filter_split(spark, sf):
    return b.image_index(spark, sf).filter("split = 'test'").select("image_id", "split")


@query(
    "filter_having_count",
    "SELECT user_id, count(*) AS count FROM events GROUP BY user_id HAVING count(*) > 1",
)
def filter_having_count(spark, sf):
    return profile.repeated(tables.parquet(spark, sf, "events"), "user_id")


@query(
    "filter_by_suffix_set",
    """SELECT page_id, lower(regexp_extract(split_part(url, '/', -1), '[^/](\\.[^./]+)$', 1)) AS suffix
    FROM pages WHERE lower(regexp_extract(split_part(url, '/', -1), '[^/](\\.[^./]+)$', 1)) = '.html'""",
)
def filter_by_suffix_set(spark, sf):
    suffix = paths.suffix_lower(paths.basename(F.col("url")))
    return (
        b.urls(spark, sf)
        .select("page_id", suffix.alias("suffix"))
        .filter(F.col("suffix").isin([".html"]))
    )


@query(
    "guard_positive",
    """SELECT l_returnflag AS model, round(100 / sum(l_quantity), 10) AS multiplier
    FROM lineitem GROUP BY 1""",
)
def guard_positive(spark, sf):
    from assaykit.operators.evaluation import guard_positive as guard

    total = b.batches(spark, sf).groupBy("model").agg(F.sum("n").alias("t"))
    return total.select(
        "model", F.round(100 / guard(F.col("t"), "throughput"), 10).alias("multiplier")
    )


@query(
    "media_type_allowed",
    """SELECT page_id, media_type, CASE WHEN media_type NOT IN ('image/jpeg', 'image/jpg',
        'image/png', 'image/webp') THEN 'unsupported_type' WHEN size = 0 THEN 'empty' END AS rejected
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'text/html'
        WHEN 2 THEN 'image/jpeg' ELSE 'image/webp' END AS media_type,
        CASE WHEN page_id % 5 = 0 THEN 0 ELSE octet_length(encode(html)) END AS size FROM pages)""",
)
def media_type_allowed(spark, sf):
    from assaykit.operators.ranking import split_uploads

    kind = F.col("page_id") % 4
    uploads = tables.parquet(spark, sf, "pages").select(
        "page_id",
        F.when(kind == 0, "image/png")
        .when(kind == 1, "text/html")
        .when(kind == 2, "image/jpeg")
        .otherwise("image/webp")
        .alias("media_type"),
        F.when(F.col("page_id") % 5 == 0, 0).otherwise(F.octet_length("html")).alias("size"),
    )
    return split_uploads(uploads).select("page_id", "media_type", "rejected")


@query("join_label_map", "SELECT image_id, label_id FROM idx", IDX)
def join_label_map(spark, sf):
    # the map is as long as the class list, so it may be sent to every task
    mapping = spark.range(1).select(
        F.posexplode(F.array(*[F.lit(c) for c in b.CLASSES])).alias("label_id", "class_name")
    )
    rows = b.image_index(spark, sf).select("image_id", "class_name")
    return rows.join(F.broadcast(mapping), "class_name").select("image_id", "label_id")


# --- profile -----------------------------------------------------------------------------------


@query(
    "class_summary",
    """SELECT split, class_name, count(*) AS image_count, round(avg(width), 1) AS avg_width,
        round(avg(height), 1) AS avg_height, round(avg(file_size_kb), 1) AS avg_file_size_kb
    FROM master GROUP BY split, class_name ORDER BY split, class_name""",
    MASTER,
)
def class_summary(spark, sf):
    return profile.class_summary(b.master(spark, sf))


ANOMALY_SQL = """SELECT {key}, count(*) AS total_images,
    CAST(sum(is_small_image) AS BIGINT) AS small_images,
    CAST(sum(is_odd_aspect) AS BIGINT) AS odd_aspect_images,
    CAST(sum(is_non_rgb) AS BIGINT) AS non_rgb_images FROM master GROUP BY {key} ORDER BY {key}"""


@query("anomaly_summary", ANOMALY_SQL.format(key="split"), MASTER)
def anomaly_summary(spark, sf):
    return profile.anomaly_counts(b.master(spark, sf), "split")


@query("class_anomaly_summary", ANOMALY_SQL.format(key="class_name"), MASTER)
def class_anomaly_summary(spark, sf):
    return profile.anomaly_counts(b.master(spark, sf), "class_name")


@query(
    "profile_cube",
    """SELECT CASE WHEN grouping(split) = 1 THEN 'class' WHEN grouping(class_name) = 1 THEN 'split'
        ELSE 'split_class' END AS grain, split, class_name, count(*) AS total_images,
        CAST(sum(is_small_image) AS BIGINT) AS small_images,
        CAST(sum(is_odd_aspect) AS BIGINT) AS odd_aspect_images,
        CAST(sum(is_non_rgb) AS BIGINT) AS non_rgb_images
    FROM master GROUP BY GROUPING SETS ((split, class_name), (split), (class_name))""",
    MASTER,
)
def profile_cube(spark, sf):
    return profile.profile_cube(b.master(spark, sf))


@query(
    "duplicate_summary",
    "SELECT md5, count(*) AS count FROM idx GROUP BY md5 HAVING count(*) > 1",
    IDX,
)
def duplicate_summary(spark, sf):
    return profile.repeated(b.image_index(spark, sf), "md5")


@query(
    "null_summary",
    "SELECT "
    + ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
        for c in profile.NULL_CHECKED
    )
    + " FROM idx",
    IDX,
)
def null_summary(spark, sf):
    return profile.null_summary(b.image_index(spark, sf))


@query("split_summary", "SELECT split, count(*) AS count FROM idx GROUP BY split ORDER BY split", IDX)
def split_summary(spark, sf):
    return profile.count_by(b.image_index(spark, sf), "split")


@query(
    "format_summary",
    "SELECT image_format, count(*) AS count FROM idx GROUP BY 1 ORDER BY 2 DESC, image_format",
    IDX,
)
def format_summary(spark, sf):
    return profile.value_counts(b.image_index(spark, sf), "image_format")


@query(
    "mode_summary",
    "SELECT image_mode, count(*) AS count FROM idx GROUP BY 1 ORDER BY 2 DESC, image_mode",
    IDX,
)
def mode_summary(spark, sf):
    return profile.value_counts(b.image_index(spark, sf), "image_mode")


@query(
    "split_class_pivot",
    "SELECT split, "
    + ", ".join(f"count(CASE WHEN class_name = '{c}' THEN 1 END) AS {c}" for c in b.CLASSES)
    + " FROM idx GROUP BY split",
    IDX,
)
def split_class_pivot(spark, sf):
    return profile.count_matrix(b.image_index(spark, sf), "split", "class_name", b.CLASSES)


@query("table_row_count", "SELECT count(*) AS n FROM documents")
def table_row_count(spark, sf):
    return tables.parquet(spark, sf, "documents").agg(F.count("*").alias("n"))


@query(
    "count_by_split_class",
    "SELECT split, class_name, count(*) AS count FROM idx GROUP BY 1, 2 ORDER BY 1, 2",
    IDX,
)
def count_by_split_class(spark, sf):
    return profile.count_by(b.image_index(spark, sf), "split", "class_name")


@query(
    "class_distribution",
    """SELECT class_name, count(*) AS count FROM idx WHERE split = 'train' AND class_name IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, class_name""",
    IDX,
)
def class_distribution(spark, sf):
    train = b.image_index(spark, sf).filter("split = 'train'")
    return profile.value_counts(train, "class_name", keep_null=False)


@query(
    "odd_size_odd_aspect",
    """SELECT image_id, CASE WHEN pixel_count < q1 - 1.5 * (q3 - q1)
        OR pixel_count > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS odd_size,
        CASE WHEN aspect_ratio > 2.5 OR aspect_ratio < 0.4 THEN 1 ELSE 0 END AS odd_aspect_ratio
    FROM idx, (SELECT quantile_cont(pixel_count, 0.25) AS q1, quantile_cont(pixel_count, 0.75) AS q3
        FROM idx)""",
    IDX,
)
def odd_size_odd_aspect(spark, sf):
    # the quartiles read the frame several times, so the text is worked through once before
    sizes = cut(b.image_index(spark, sf).select("image_id", "pixel_count", "aspect_ratio"))
    return profile.size_outliers(sizes, "pixel_count").select(
        "image_id",
        "odd_size",
        quality.is_odd_aspect(F.col("aspect_ratio")).alias("odd_aspect_ratio"),
    )


# --- counters, sorting, sets -------------------------------------------------------------------


@query(
    "per_class_counter",
    """SELECT doc_id, split, class_name, row_number() OVER (PARTITION BY split, class_name
        ORDER BY doc_id) AS counter FROM idx
    WHERE class_name IN ('c0', 'c1', 'c2') AND doc_id IN (SELECT doc_id FROM labels)""",
    IDX,
)
def per_class_counter(spark, sf):
    listed = index.selected_classes(
        b.listing(spark, sf).select("doc_id", "split", "class_name"), b.CLASSES[:3]
    )
    there = index.only_listed(listed, tables.parquet(spark, sf, "labels"), "doc_id")
    return index.per_class_counter(there, order="doc_id").select(
        "doc_id", "split", "class_name", "counter"
    )


@query(
    "order_by_keys",
    "SELECT split, class_name, image_id FROM idx ORDER BY split, class_name, image_id",
    IDX,
)
def order_by_keys(spark, sf):
    return (
        b.image_index(spark, sf)
        .select("split", "class_name", "image_id")
        .orderBy("split", "class_name", "image_id")
    )


@query(
    "page_limit_offset",
    "SELECT image_id, split, class_name FROM idx ORDER BY image_id LIMIT 25 OFFSET 50",
    IDX,
)
def page_limit_offset(spark, sf):
    rows = b.image_index(spark, sf).select("image_id", "split", "class_name")
    return validation.page(rows, ["image_id"], limit=25, offset=50)


@query(
    "union_splits",
    "SELECT image_id, split FROM idx",
    IDX,
)
def union_splits(spark, sf):
    rows = b.image_index(spark, sf).select("image_id", "split")
    return rows.filter("split = 'train'").unionByName(rows.filter("split = 'test'"))


@query(
    "union_distinct_ordered",
    """SELECT tag AS version_tag, CAST(min(place) AS INTEGER) AS place FROM (
        SELECT 'cleaned_v1' AS tag, 0 AS place UNION ALL SELECT '', 1
        UNION ALL SELECT 'cleaned_v' || (user_id % 4), 2 FROM events)
    WHERE tag <> '' GROUP BY tag""",
)
def union_distinct_ordered(spark, sf):
    from assaykit.operators.runs import tags_in_order

    one = spark.range(1)
    default = one.select(F.lit("cleaned_v1").alias("version_tag"))
    active = one.select(F.lit("").alias("version_tag"))
    found = tables.parquet(spark, sf, "events").select(
        F.concat(F.lit("cleaned_v"), (F.col("user_id") % 4).cast("string")).alias("version_tag")
    )
    return tags_in_order([default, active, found])


@query(
    "missing_columns",
    """SELECT 'image_id' AS key, count(*) AS n_rows, 11 AS n_missing FROM documents""",
)
def missing_columns(spark, sf):
    from assaykit.schemas import IMAGES, missing_columns as lacking

    master = b.master(spark, sf)
    # one declared column is taken away; with the six never computed and four more that makes 11
    kept = master.drop("md5", "channels", "exif_tag_count", "source_dataset", "label_id")
    gaps = lacking(kept, IMAGES)
    return kept.agg(F.count("*").alias("n_rows")).select(
        F.lit("image_id").alias("key"), "n_rows", F.lit(len(gaps)).alias("n_missing")
    )


@query(
    "concat_manifests",
    """SELECT 'docs/' || doc_id AS path, octet_length(encode(text)) AS size FROM documents
    UNION ALL SELECT 'pages/' || page_id, octet_length(encode(html)) FROM pages""",
)
def concat_manifests(spark, sf):
    return manifest_entries(spark, sf).select("path", "size")


def manifest_entries(spark, sf):
    docs = tables.parquet(spark, sf, "documents").select(
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string")).alias("path"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.sha2("text", 256).alias("sha256"),
    )
    pages = tables.parquet(spark, sf, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string")).alias("path"),
        F.octet_length("html").cast("bigint").alias("size"),
        F.sha2("html", 256).alias("sha256"),
    )
    return docs.unionByName(pages)


MANIFEST_SQL = """WITH entry AS (SELECT 'docs/' || doc_id AS path, octet_length(encode(text)) AS size,
            sha256(text) AS sha FROM documents
        UNION ALL SELECT 'pages/' || page_id, octet_length(encode(html)), sha256(html) FROM pages),
    leaf AS (SELECT substr(md5(path), 1, 5) AS bucket,
            sha256(string_agg(path || '|' || size || '|' || sha, chr(10) ORDER BY path)) AS digest
        FROM entry GROUP BY 1),
    branch AS (SELECT substr(bucket, 1, 2) AS branch,
            sha256(string_agg(digest, chr(10) ORDER BY bucket)) AS digest FROM leaf GROUP BY 1)
    SELECT sha256(string_agg(digest, chr(10) ORDER BY branch)) AS manifest_sha256 FROM branch"""


@query("manifest_hash", MANIFEST_SQL)
def manifest_hash(spark, sf):
    return versions.manifest_hash(manifest_entries(spark, sf))


# --- integrity ---------------------------------------------------------------------------------


@query(
    "check_unique_key",
    "SELECT version_tag, count(*) AS n FROM vlog GROUP BY 1 HAVING count(*) > 1",
    ("vlog",),
)
def check_unique_key(spark, sf):
    return integrity.repeated_keys(b.version_log(spark, sf), "version_tag")


@query(
    "check_foreign_key",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def check_foreign_key(spark, sf):
    docs = tables.parquet(spark, sf, "documents").select("doc_id")
    return integrity.missing_parents(docs, tables.parquet(spark, sf, "labels"), "doc_id")


@query(
    "check_one_to_one",
    """SELECT md5, count(*) AS n, 'left' AS side FROM idx GROUP BY md5 HAVING count(*) > 1
    UNION ALL SELECT md5, count(*), 'right' FROM idx WHERE split = 'test' GROUP BY md5
    HAVING count(*) > 1""",
    IDX,
)
def check_one_to_one(spark, sf):
    rows = b.image_index(spark, sf).select("md5", "split")
    return integrity.one_to_one(rows, rows.filter("split = 'test'"), "md5")


@query(
    "check_row_count_match",
    """SELECT CAST((SELECT count(*) FROM documents) AS BIGINT) AS left_rows,
        CAST((SELECT count(*) FROM labels) AS BIGINT) AS right_rows,
        (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS only_left,
        (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
            AS only_right,
        CASE WHEN (SELECT count(*) FROM documents) = (SELECT count(*) FROM labels) THEN 1 ELSE 0 END
            AS matches""",
)
def check_row_count_match(spark, sf):
    docs = tables.parquet(spark, sf, "documents").select("doc_id")
    labels = tables.parquet(spark, sf, "labels").select("doc_id")
    return integrity.row_count_match(docs, labels, "doc_id")


@query(
    "check_not_null",
    """SELECT version_tag, created_at, o_orderkey FROM vlog WHERE version_tag IS NULL
        OR git_commit IS NULL""",
    ("vlog",),
)
def check_not_null(spark, sf):
    return integrity.nulls_in(b.version_log(spark, sf), ["version_tag", "git_commit"]).select(
        "version_tag", "created_at", "o_orderkey"
    )


@query(
    "check_bounds",
    """SELECT event_id, value FROM events WHERE value IS NULL OR value < 1 OR value > 50""",
)
def check_bounds(spark, sf):
    rows = tables.parquet(spark, sf, "events").select("event_id", "value")
    return integrity.out_of_bounds(rows, "value", 1.0, 50.0)


@query(
    "checks_on_write",
    """SELECT count(*) AS n_rows, count_if(user_id IS NULL OR ts IS NULL) AS n_nulls,
        count_if(value IS NULL OR value < 1 OR value > 50) AS out_of_bounds_value FROM events""",
)
def checks_on_write(spark, sf):
    """Row count, nulls and bounds counted while the table is written."""
    rows = tables.parquet(spark, sf, "events")
    found = integrity.write_checked(rows, scratch_path(spark, "events"), ["user_id", "ts"], {"value": (1.0, 50.0)})
    return spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in found.items()])


@query(
    "dataset_ready",
    "SELECT CASE WHEN count(*) > 0 THEN 'ok' ELSE 'degraded' END AS status FROM documents",
)
def dataset_ready(spark, sf):
    return integrity.readiness(tables.parquet(spark, sf, "documents"))


# --- dataset versions --------------------------------------------------------------------------


def version_table(spark, sf):
    """Last record of each tag, numbered in the order they were written."""
    from assaykit.operators.skew import blocked_row_number

    last = versions.latest_per_tag(b.version_log(spark, sf), "written")
    numbered = blocked_row_number(
        last, [], F.substring("created_at", 1, 7), [F.col("created_at"), F.col("o_orderkey")], "id"
    )
    return numbered.withColumn("version_id", F.col("id").cast("int")).drop("id")


LISTING = (
    "version_tag",
    "raw_image_count",
    "cleaned_image_count",
    "git_commit",
    "created_at",
    "notes",
)


@query(
    "scan_dataset_versions",
    """SELECT version_id AS id, version_tag, raw_image_count, cleaned_image_count, git_commit,
        created_at, notes FROM versions ORDER BY created_at DESC""",
    ("versions",),
)
def scan_dataset_versions(spark, sf):
    return versions.version_listing(version_table(spark, sf))


@query(
    "newest_versions",
    "SELECT version_tag, created_at, o_orderkey FROM vlog ORDER BY created_at DESC, o_orderkey DESC",
    ("vlog",),
)
def newest_versions(spark, sf):
    return (
        b.version_log(spark, sf)
        .select("version_tag", "created_at", "o_orderkey")
        .orderBy(F.desc("created_at"), F.desc("o_orderkey"))
    )


@query(
    "list_versions",
    """SELECT version_id AS id, version_tag, created_at FROM versions ORDER BY created_at DESC""",
    ("versions",),
)
def list_versions(spark, sf):
    return versions.version_listing(version_table(spark, sf)).select(
        "id", "version_tag", "created_at"
    )


VERSION_DEFAULT_SQL = """SELECT t.tag AS version_tag, v.version_id, v.created_at,
        CASE WHEN v.version_id IS NULL THEN 'unknown' ELSE v.git_commit END AS git_commit
    FROM (SELECT DISTINCT o_orderpriority || '/' || o_orderstatus AS tag FROM orders
        UNION SELECT DISTINCT 'ghost/' || o_orderstatus FROM orders) t
    LEFT JOIN versions v ON v.version_tag = t.tag"""


def _asked_tags(spark, sf):
    orders = tables.parquet(spark, sf, "orders")
    real = orders.select(F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("version_tag"))
    ghost = orders.select(F.concat(F.lit("ghost/"), "o_orderstatus").alias("version_tag"))
    return real.distinct().unionByName(ghost.distinct())


@query(
    "scan_version_by_tag",
    """SELECT version_tag, version_id, git_commit, created_at FROM versions
    WHERE version_tag = '1-URGENT/F'""",
    ("versions",),
)
def scan_version_by_tag(spark, sf):
    tag = spark.range(1).select(F.lit("1-URGENT/F").alias("version_tag"))
    return versions.version_by_tag(tag, version_table(spark, sf)).select(
        "version_tag", "version_id", "git_commit", "created_at"
    )


@query("join_version_default", VERSION_DEFAULT_SQL, ("versions",))
def join_version_default(spark, sf):
    found = versions.version_by_tag(_asked_tags(spark, sf), version_table(spark, sf))
    return found.select("version_tag", "version_id", "created_at", "git_commit")


@query(
    "upsert_version",
    """, old AS (SELECT row_number() OVER (ORDER BY created_at, o_orderkey) AS id, * FROM (
        SELECT * FROM vlog WHERE created_at < '1998-01-01' QUALIFY row_number() OVER (
            PARTITION BY version_tag ORDER BY created_at DESC, o_orderkey DESC) = 1)),
    new AS (SELECT row_number() OVER (ORDER BY created_at, o_orderkey) AS id, * FROM (
        SELECT * FROM vlog WHERE created_at >= '1998-01-01' AND version_tag LIKE '%/F'
        QUALIFY row_number() OVER (
            PARTITION BY version_tag ORDER BY created_at DESC, o_orderkey DESC) = 1))
    SELECT CAST(id AS INTEGER) AS version_id, version_tag, created_at, notes FROM old
    WHERE version_tag NOT IN (SELECT version_tag FROM new)
    UNION ALL SELECT CAST(id + (SELECT max(id) FROM old) AS INTEGER), version_tag, created_at, notes
    FROM new""",
    ("vlog",),
)
def upsert_version(spark, sf):
    from assaykit.operators.skew import blocked_row_number

    log = b.version_log(spark, sf)
    month = F.substring("created_at", 1, 7)
    old = versions.latest_per_tag(log.filter("created_at < '1998-01-01'"), "written")
    order = [F.col("created_at"), F.col("o_orderkey")]
    # the ids of the old table are given only over the rows that are kept whole in it
    existing = blocked_row_number(old, [], month, order, "version_id").withColumn(
        "version_id", F.col("version_id").cast("int")
    )
    new = log.filter("created_at >= '1998-01-01'").filter(F.col("version_tag").endswith("/F"))
    incoming = versions.latest_per_tag(new, "written")
    return versions.upsert_versions(existing, incoming, "written", month).select(
        "version_id", "version_tag", "created_at", "notes"
    )


POINTER_SQL = "(SELECT md5(arg_min(r_name, md5(r_name))) FROM region WHERE r_regionkey % 3 = {})"


@query(
    "build_version_record",
    f"""SELECT 'cleaned_v1' AS version_tag, (SELECT count(*) FROM pages WHERE NOT ends_with(url, '/')) AS raw_image_count,
        CAST(0 AS BIGINT) AS cleaned_image_count, {POINTER_SQL.format(0)} AS raw_dvc_md5,
        {POINTER_SQL.format(1)} AS cleaned_dvc_md5, {POINTER_SQL.format(2)} AS reports_dvc_md5,
        (SELECT manifest_sha256 FROM ({MANIFEST_SQL})) AS manifest_sha256,
        CAST(NULL AS VARCHAR) AS git_commit, '{b.STAMP}' AS created_at, '' AS notes""",
)
def build_version_record(spark, sf):
    raw = b.urls(spark, sf).select(F.concat("url", F.lit(".jpg")).alias("path"))
    pointers = (
        tables.parquet(spark, sf, "region")
        .select(
            F.element_at(
                F.array(F.lit("raw"), F.lit("cleaned"), F.lit("reports")),
                (F.col("r_regionkey") % 3 + 1).cast("int"),
            ).alias("name"),
            F.concat(F.lit("- md5: "), F.md5("r_name")).alias("value"),
        )
        .groupBy("name")
        .agg(F.min("value").alias("value"))
    )
    return versions.version_record(
        "cleaned_v1",
        raw,
        b.image_index(spark, sf).select(F.col("raw_path").alias("path")),
        files.pointer_md5(pointers),
        manifest_entries(spark, sf),
        None,
        b.STAMP,
    )
