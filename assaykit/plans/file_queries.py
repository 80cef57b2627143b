"""Queries that write files from the tables and read them back, image measures and ML."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from assaykit.functions import numeric, paths, quality
from assaykit.operators import candidates, evaluation, images, index, profile, ranking, training, validation
from assaykit.plans import bindings as b
from assaykit.plans.catalog import query
from assaykit.plans.model_queries import HISTORY_SQL, MODEL_OF, report_rows
from assaykit.plans.validation_queries import validated
from assaykit.schemas import IMAGES, INDEX, REPORT, RUN_LOG
from assaykit.session import cut, scratch_path
from assaykit.sources import files, listing, runstore, sinks, tables

IDX = ("idx",)


@query(
    "scan_line_list",
    """SELECT url AS line, count(*) AS n FROM pages WHERE trim(url) <> '' GROUP BY url""",
)
def scan_line_list(spark, sf):
    """URLs written as a list with blank lines and padding, read back."""
    path = scratch_path(spark, "split.txt")
    rows = b.urls(spark, sf)
    padded = rows.select(F.explode(F.array(F.concat(F.lit("  "), "url"), F.lit(" "))).alias("value"))
    padded.write.text(path)
    return (
        files.line_list(spark, path)
        .groupBy(F.col("value").alias("line"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "scan_index_csv",
    """SELECT image_id, split, class_name, label_id, width, height, channels, image_mode, aspect_ratio,
        pixel_count, file_size_bytes, md5 FROM idx""",
    IDX,
)
def scan_index_csv(spark, sf):
    path = scratch_path(spark, "index.csv")
    sinks.index_csv(b.image_index(spark, sf), path)
    return files.index_csv(spark, path).select(
        "image_id",
        "split",
        "class_name",
        "label_id",
        "width",
        "height",
        "channels",
        "image_mode",
        "aspect_ratio",
        "pixel_count",
        "file_size_bytes",
        "md5",
    )


@query(
    "write_index_csv",
    "SELECT count(*) AS n, CAST(sum(width) AS BIGINT) AS total_width FROM idx",
    IDX,
)
def write_index_csv(spark, sf):
    path = scratch_path(spark, "index.csv")
    sinks.index_csv(b.image_index(spark, sf), path)
    return spark.read.schema(INDEX).option("header", True).csv(path).agg(
        F.count("*").alias("n"), F.sum("width").alias("total_width")
    )


@query(
    "write_master_parquet",
    """SELECT split, count(*) AS n, CAST(sum(is_small_image) AS BIGINT) AS small_images FROM master
    GROUP BY split""",
    ("master",),
)
def write_master_parquet(spark, sf):
    path = scratch_path(spark, "master")
    sinks.master_parquet(b.master(spark, sf), path, by=("split",))
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(
        F.count("*").alias("n"), F.sum("is_small_image").alias("small_images")
    )


SUMMARY_SQL = """SELECT 'class_summary' AS summary, count(*) AS n_rows FROM (SELECT DISTINCT split, class_name FROM idx)
    UNION ALL SELECT 'anomaly_summary', count(DISTINCT split) FROM idx
    UNION ALL SELECT 'duplicate_summary', count(*) FROM (SELECT md5 FROM idx GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'null_summary', 1
    UNION ALL SELECT 'class_anomaly_summary', count(DISTINCT class_name) FROM idx
    UNION ALL SELECT 'split_summary', count(DISTINCT split) FROM idx
    UNION ALL SELECT 'format_summary', count(*) FROM (SELECT DISTINCT image_format FROM idx)
    UNION ALL SELECT 'mode_summary', count(*) FROM (SELECT DISTINCT image_mode FROM idx)"""


@query("write_summaries", SUMMARY_SQL, IDX)
def write_summaries(spark, sf):
    """The eight profile tables of one materialised master frame, one CSV each, and their row counts.
    The table of repeated digests grows with the data, so it keeps its partitions."""
    master = cut(b.master(spark, sf))
    small = {
        "class_summary": profile.class_summary(master),
        "anomaly_summary": profile.anomaly_counts(master, "split"),
        "null_summary": profile.null_summary(master),
        "class_anomaly_summary": profile.anomaly_counts(master, "class_name"),
        "split_summary": profile.count_by(master, "split"),
        "format_summary": profile.value_counts(master, "image_format"),
        "mode_summary": profile.value_counts(master, "image_mode"),
    }
    root = scratch_path(spark, "quality")
    for name, frame in small.items():
        sinks.summary_csv(frame, f"{root}/{name}")
    sinks.index_csv(profile.repeated(master, "md5"), f"{root}/duplicate_summary")
    out = None
    for name in [*small, "duplicate_summary"]:
        back = spark.read.option("header", True).csv(f"{root}/{name}")
        row = back.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("summary"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "create_table_if_missing",
    """SELECT TRUE AS made, FALSE AS made_again, CAST(0 AS BIGINT) AS rows_before, count(*) AS rows_after
    FROM documents""",
)
def create_table_if_missing(spark, sf):
    """The managed table is made once, is empty then, and keeps its rows when asked for again."""
    name = f"image_metadata_{uuid.uuid4().hex[:12]}"
    made = tables.create_if_missing(spark, name, IMAGES)
    before = spark.table(name).count()
    tables.refresh(b.master(spark, sf), name, IMAGES)
    again = tables.create_if_missing(spark, name, IMAGES)
    return spark.table(name).agg(F.count("*").alias("rows_after")).select(
        F.lit(made).alias("made"), F.lit(again).alias("made_again"), F.lit(before).alias("rows_before"), "rows_after"
    )


@query(
    "write_validation_reports",
    """SELECT 'summary' AS report, CAST(count(*) AS BIGINT) AS total FROM validated
    UNION ALL SELECT 'by_split_class', CAST(count(*) AS BIGINT) FROM validated
    UNION ALL SELECT 'duplicates', count(*) FROM validated WHERE is_exact_duplicate = 1
        OR is_near_duplicate = 1 OR manual_review_required = 1 OR duplicate_of IS NOT NULL
    UNION ALL SELECT 'rows', count(*) FROM validated""",
    ("validated",),
    groups="exact_groups",
)
def write_validation_reports(spark, sf):
    table = cut(validated(spark, sf))
    root = scratch_path(spark, "validation_reports")
    sinks.index_csv(table, f"{root}/rows")
    sinks.summary_csv(validation.validation_summary(table), f"{root}/summary")
    sinks.summary_csv(validation.validation_by_split_class(table), f"{root}/by_split_class")
    sinks.index_csv(validation.duplicate_report(table), f"{root}/duplicates")

    def read(name):
        return spark.read.option("header", True).csv(f"{root}/{name}")

    def counted(name, frame):
        return frame.select(F.lit(name).alias("report"), F.col("total").cast("bigint"))

    total = F.sum(F.col("total_images").cast("bigint")).alias("total")
    n = F.count("*").alias("total")
    return (
        counted("summary", read("summary").agg(total))
        .unionByName(counted("by_split_class", read("by_split_class").agg(total)))
        .unionByName(counted("duplicates", read("duplicates").agg(n)))
        .unionByName(counted("rows", read("rows").agg(n)))
    )


REPORT_FIGURES = f""", lat AS (SELECT {MODEL_OF} AS model, pround(avg(value), 3) AS mean_ms,
        pround(1000 / avg(value), 1) AS tp FROM events GROUP BY event_type)
    SELECT replace(p.model, 'net', 'm') AS model_name, 'cleaned_v1' AS version_tag,
        pround(sum(hits) / sum(support), 4) AS accuracy, mean_ms AS latency_mean_ms,
        pround(100 / tp, 4) AS cost_per_1k_dkk FROM params p
    LEFT JOIN cls c ON c.model = replace(p.model, 'net', 'm')
    LEFT JOIN lat ON lat.model = replace(p.model, 'net', 'm')
    GROUP BY p.model, mean_ms, tp"""

SHOWN_FIGURES = (
    REPORT_FIGURES.replace("pround(sum(hits) / sum(support), 4) AS", "coalesce(pround(sum(hits) / sum(support), 4), 0.0) AS")
    .replace("mean_ms AS latency_mean_ms", "coalesce(mean_ms, 0.0) AS latency_mean_ms")
    .replace("pround(100 / tp, 4) AS", "coalesce(pround(100 / tp, 4), 0.0) AS")
    + """ UNION ALL SELECT m, 'cleaned_v1', 0.0, 0.0, 0.0 FROM (VALUES ('m7'), ('m8')) absent(m)"""
)


@query("scan_report_json", SHOWN_FIGURES, ("cls", "params"))
def scan_report_json(spark, sf):
    """Reports as JSON text, parsed back and looked up for the artifacts m0..m8. A report without a
    figure, the broken one of m7 and the absent one of m8 show zeros."""
    texts = report_rows(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    broken = spark.range(1).select(F.lit('{"model": "m7", "quality": ').alias("value"))
    parsed = files.parse_reports(texts.unionByName(broken)).select("report.*")
    artifacts = spark.range(9).select(
        F.concat(F.lit("m"), "id").alias("model_name"), F.lit("cleaned_v1").alias("version_tag")
    )
    meta = files.with_report_meta(artifacts, files.report_meta(parsed))
    return meta.select(
        "model_name", "version_tag", "accuracy", "latency_mean_ms", "cost_per_1k_dkk"
    )


@query("write_eval_report_json", REPORT_FIGURES, ("cls", "params"))
def write_eval_report_json(spark, sf):
    path = scratch_path(spark, "reports.json")
    sinks.report_json(report_rows(spark, sf), path)
    meta = files.report_meta(spark.read.schema(REPORT).json(path))
    return meta.select(
        "model_name", "version_tag", "accuracy", "latency_mean_ms", "cost_per_1k_dkk"
    )


@query("write_eval_tables", HISTORY_SQL, ("batches",))
def write_eval_tables(spark, sf):
    """Per-class table, history and matrix of every model written; the history read back."""
    root = scratch_path(spark, "evaluation")
    predictions = cut(b.predictions(spark, sf))
    sinks.summary_csv(evaluation.per_class_report(predictions), f"{root}/per_class")
    matrix = evaluation.matrix_rows(evaluation.confusion_matrix(predictions, 10))
    sinks.report_json(matrix, f"{root}/confusion_matrix")
    sinks.summary_csv(evaluation.epoch_history(b.batches(spark, sf)), f"{root}/history")
    shape = """model string, epoch int, train_loss double, train_acc double, val_loss double,
        val_acc double"""
    return spark.read.schema(shape).option("header", True).csv(f"{root}/history")


@query(
    "write_comparison",
    """SELECT replace(p.model, 'net', 'm') AS model, pround(sum(hits) / sum(support), 4) AS accuracy,
        'cleaned_v1' AS version_tag
    FROM params p LEFT JOIN cls ON cls.model = replace(p.model, 'net', 'm') GROUP BY p.model""",
    ("cls", "params"),
)
def write_comparison(spark, sf):
    path = scratch_path(spark, "model_comparison_cleaned_v1.csv")
    sinks.summary_csv(evaluation.model_comparison(report_rows(spark, sf)), path)
    return files.comparison_csv(spark, path, "cleaned_v1").select(
        "model", "accuracy", "version_tag"
    )


@query(
    "log_params_metrics",
    """SELECT model AS run_id, epoch AS step, 'acc' AS key, acc AS value FROM epochs""",
    ("epochs",),
)
def log_params_metrics(spark, sf):
    """Epoch metrics appended to a run log in two writes, read back."""
    path = scratch_path(spark, "run_log")
    epochs = b.epochs(spark, sf).withColumn("ts", F.col("epoch").cast("bigint") * 86_400_000)
    for half in (F.col("epoch") <= 15, F.col("epoch") > 15):
        rows = sinks.metric_rows(epochs.filter(half), "room", "model", "epoch", "ts")
        sinks.append_run_log(rows, path)
    back = spark.read.schema(RUN_LOG).parquet(path)
    return back.select(
        "run_id",
        F.col("step").cast("int").alias("step"),
        "key",
        F.col("value").cast("double").alias("value"),
    )


@query(
    "scan_run_store",
    """SELECT 'exp' AS experiment, 'run_' || (user_id % 8) AS run_id, 'metric' AS kind, event_type AS key,
        event_id AS step, epoch_us(ts) // 1000 AS ts, value FROM events""",
)
def scan_run_store(spark, sf):
    """Metric lines `millis value step` written one folder per run and key, read back by path."""
    root = scratch_path(spark, "runs")
    lines = tables.parquet(spark, sf, "events").select(
        F.concat(F.lit("run_"), (F.col("user_id") % 8).cast("string")).alias("run"),
        F.lit("metrics").alias("kind"),
        F.col("event_type").alias("key"),
        F.concat_ws(
            " ", b.event_millis().cast("string"), F.col("value").cast("string"), "event_id"
        ).alias("value"),
    )
    lines.write.partitionBy("run", "kind", "key").text(f"{root}/exp")
    log = runstore.run_log(spark, root, runstore.WRITTEN_RUN_FILE)
    return log.withColumn("value", F.col("value").cast("double"))


@query(
    "scan_pointer_md5",
    """SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN md5(url) END AS md5 FROM pages""",
)
def scan_pointer_md5(spark, sf):
    """Pointer documents with a digest line, one in four without."""
    text = F.when(
        F.col("page_id") % 4 != 0,
        F.concat(F.lit("outs:\n- md5:  "), F.md5("url"), F.lit("\n  size: 12\n  hash: md5\n")),
    ).otherwise(F.concat(F.lit("outs:\n- path: "), "url"))
    pointers = b.urls(spark, sf).select("page_id", text.alias("value"))
    return files.pointer_md5(pointers).select("page_id", "md5")


@query(
    "count_files_by_ext",
    "SELECT count(*) AS n_images FROM pages WHERE page_id % 3 <> 0",
)
def count_files_by_ext(spark, sf):
    """A file per page, written below nested folders and listed by the executors."""
    suffix = F.when(F.col("page_id") % 3 == 0, ".txt").when(F.col("page_id") % 3 == 1, ".JPG")
    page = F.col("page_id").cast("string")
    name = F.concat(F.lit("raw/"), (F.col("page_id") % 11).cast("string"), F.lit("/"), page, F.coalesce(suffix, F.lit(".webp")))
    root = scratch_path(spark, "files")
    listing.write_each(tables.parquet(spark, sf, "pages").select(name.alias("name"), F.col("url").alias("content")), root)
    return files.count_images(listing.list_files(spark, root))


@query(
    "latest_artifact",
    """SELECT 'f' || event_id AS name, epoch_us(ts) // 1000 AS modified FROM events
    ORDER BY CASE WHEN event_id = 17 THEN 0 ELSE 1 END, ts DESC, name LIMIT 1""",
)
def latest_artifact(spark, sf):
    listed = tables.parquet(spark, sf, "events").select(
        F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("name"),
        b.event_millis().alias("modified"),
    )
    return files.latest_artifact(listed, "f17").select("name", "modified")


# --- images ------------------------------------------------------------------------------------


@query(
    "image_headers",
    """SELECT vec_id, CASE WHEN label <> 9 THEN 8 END AS width, CASE WHEN label <> 9 THEN 8 END AS height,
        CASE WHEN label <> 9 THEN 1 END AS channels, CASE WHEN label <> 9 THEN 'L' END AS image_mode,
        CASE WHEN label <> 9 THEN 'PNG' END AS image_format FROM embeddings""",
)
def image_headers(spark, sf):
    heads = images.image_headers(b.derived_images(spark, sf))
    number = F.regexp_extract("path", r"(\d+)", 1).cast("bigint")
    return heads.select(
        number.alias("vec_id"), "width", "height", "channels", "image_mode", "image_format"
    )


@query(
    "scan_image_files",
    """SELECT printf('images/%06d.png', vec_id) AS path, 64 AS n_bytes,
        CASE WHEN label <> 9 THEN 64 END AS pixel_count FROM embeddings""",
)
def scan_image_files(spark, sf):
    """Sizes from the headers; an undecodable image has no pixel count."""
    shots = b.derived_images(spark, sf)
    heads = images.image_headers(shots).select("path", "width", "height")
    sizes = shots.select("path", F.octet_length("image.data").alias("n_bytes"))
    return sizes.join(heads, "path").select(
        "path", "n_bytes", quality.pixel_count(F.col("width"), F.col("height")).alias("pixel_count")
    )


@query(
    "channels_from_shape",
    "SELECT vec_id, CASE WHEN label <> 9 THEN 1 END AS channels FROM embeddings",
)
def channels_from_shape(spark, sf):
    heads = images.image_headers(b.derived_images(spark, sf))
    return heads.select(
        F.regexp_extract("path", r"(\d+)", 1).cast("bigint").alias("vec_id"), "channels"
    )


@query(
    "is_corrupt",
    "SELECT vec_id, CASE WHEN label = 9 THEN 1 ELSE 0 END AS is_corrupt FROM embeddings",
)
def is_corrupt(spark, sf):
    heads = images.image_headers(b.derived_images(spark, sf))
    return heads.select(
        F.regexp_extract("path", r"(\d+)", 1).cast("bigint").alias("vec_id"), "is_corrupt"
    )


PIXELS = """WITH px AS (SELECT vec_id, list_transform(embedding, lambda x:
        least(greatest(floor((CAST(x AS DOUBLE) + 0.5) * 255), 0), 255)) AS p FROM embeddings WHERE label <> 9)"""


@query(
    "pixel_stats",
    PIXELS
    + """, c AS (SELECT vec_id, p, unnest(p) AS v FROM px),
    h AS (SELECT vec_id, v, count(*) / 64 AS s FROM c GROUP BY vec_id, v),
    e AS (SELECT vec_id, round(-sum(s * log2(s)) / 8, 6) AS entropy FROM h GROUP BY vec_id),
    q AS (SELECT vec_id, round(quantile_cont(v, 0.99) / 255, 6) AS dark,
        round(1 - quantile_cont(v, 0.05) / 255, 6) AS light FROM c GROUP BY vec_id),
    l AS (SELECT vec_id, round(var_pop(p[i * 8 + j + 1 - 8] + p[i * 8 + j + 1 + 8] + p[i * 8 + j]
        + p[i * 8 + j + 2] - 4 * p[i * 8 + j + 1]) / 65025, 6) AS sharp
        FROM px, range(1, 7) a(i), range(1, 7) b(j) GROUP BY vec_id)
    SELECT printf('images/%06d.png', q.vec_id) AS path, dark AS dark_score, light AS light_score,
        sharp AS blurry_score, entropy AS low_information_score
    FROM q JOIN e ON e.vec_id = q.vec_id JOIN l ON l.vec_id = q.vec_id""",
)
def pixel_stats(spark, sf):
    return images.pixel_stats(b.derived_images(spark, sf)).select(
        "path", "dark_score", "light_score", "blurry_score", "low_information_score"
    )


@query(
    "perceptual_hash",
    PIXELS
    + """SELECT printf('images/%06d.png', vec_id) AS path,
        array_to_string(list_transform(p, lambda x: CASE WHEN x > list_avg(p) THEN '1' ELSE '0' END), '')
        AS bits FROM px""",
)
def perceptual_hash(spark, sf):
    hashes = images.perceptual_hash(b.derived_images(spark, sf))
    return hashes.select("path", F.lpad(F.bin("phash"), 64, "0").alias("bits"))


# --- candidates --------------------------------------------------------------------------------


def _features(spark, sf):
    return candidates.with_features(b.letter_shares(spark, sf))


def _split(df):
    held = F.col("item") % 5 == 0
    return df.filter(~held), df.filter(held)


def _majority(test):
    """One row: the share of the largest class, which a constant guess would reach."""
    sizes = test.groupBy("label").agg(F.count("*").alias("n"))
    return sizes.agg(numeric.half_even(F.max("n") / F.sum("n"), 4).alias("majority"))


#: By how much a trained model has to exceed the majority class on rows it has not seen.
MARGIN = 0.1
KNOWN_SQL = f"""(SELECT doc_id, list_position({b.LANGS}, lang) - 1 AS label FROM documents
    WHERE lang IN ({", ".join(repr(c) for c in b.LANGS)}) AND text IS NOT NULL)"""
MAJORITY_SQL = f"""(SELECT round(max(n) / sum(n), 4) FROM (SELECT count(*) AS n FROM {KNOWN_SQL}
    WHERE doc_id % 5 = 0 GROUP BY label))"""
CANDIDATE_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in sorted(candidates.NAMES)) + ") c(model)"


@query(
    "train_candidates",
    f"""SELECT model, (SELECT count(*) FROM {KNOWN_SQL} WHERE doc_id % 5 = 0) AS n_scored,
        TRUE AS accuracy_recomputed, {MAJORITY_SQL} AS majority, TRUE AS above_majority FROM {CANDIDATE_SQL}""",
)
def train_candidates(spark, sf):
    """Every candidate fitted on the training rows and scored on the held-out ones; the accuracy it
    reaches is the one recounted from its stored scores, and above the majority class by MARGIN."""
    train, test = _split(cut(_features(spark, sf)))
    fitted = candidates.train_candidates(train)
    scored = cut(candidates.score_all(fitted, test, b.LANGS))
    best = F.array_position("probs", F.array_max("probs")) - 1
    recounted = scored.groupBy("model").agg(
        F.count("*").alias("n_scored"),
        numeric.half_even(F.count_if(best == F.col("label")) / F.count("*"), 4).alias("again"),
    )
    reached = recounted.join(evaluation.accuracy(scored), "model").crossJoin(F.broadcast(_majority(test)))  # one row
    return reached.select(
        "model",
        "n_scored",
        (F.col("again") == F.col("accuracy")).alias("accuracy_recomputed"),
        "majority",
        (F.col("accuracy") >= F.col("majority") + MARGIN).alias("above_majority"),
    )


@query("batch_score", f"SELECT doc_id AS item, label, TRUE AS consistent, TRUE AS above_majority FROM {KNOWN_SQL}")
def batch_score(spark, sf):
    """All rows scored by one candidate; class, confidence and the score of every class agree, and the
    held-out rows are right more often by MARGIN than their majority class."""
    rows = cut(_features(spark, sf))
    train, test = _split(rows)
    model = candidates.estimators()["logistic_regression"].fit(train)
    scored = cut(candidates.batch_score(model, rows, "logistic_regression", b.LANGS))
    right = scored.filter(F.col("item") % 5 == 0).agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("right"))
    floor = _majority(test).crossJoin(right).select((F.col("right") >= F.col("majority") + MARGIN).alias("above_majority"))
    named = F.get("scores", F.col("pred"))
    best = F.array_max(F.transform("scores", lambda s: s["confidence"]))
    return scored.crossJoin(F.broadcast(floor)).select(  # one row
        "item",
        "label",
        "above_majority",
        (
            (named["class_name"] == F.col("predicted_class"))
            & (named["confidence"] == F.col("confidence"))
            & (best == F.col("confidence"))
        ).alias("consistent"),
    )


@query(
    "evaluate_candidates",
    f"""SELECT model, TRUE AS in_range, TRUE AS placed, {MAJORITY_SQL} AS majority, TRUE AS above_majority FROM {CANDIDATE_SQL}""",
)
def evaluate_candidates(spark, sf):
    """Metrics of every candidate, then their ranking, which follows the accuracy; accuracy stands for
    all quality measures of the comparison."""
    train, test = _split(cut(_features(spark, sf)))
    fitted = candidates.train_candidates(train)
    scored = cut(candidates.score_all(fitted, test, b.LANGS))
    metrics = evaluation.quality_metrics(scored).join(evaluation.top2_accuracy(scored), "model")
    table = metrics.withColumns(
        {
            "comparison_id": F.lit("trained"),
            "version_tag": F.lit("cleaned_v1"),
            "latency_mean_ms": F.lit(None).cast("double"),
            "cost_per_1k_images_dkk": F.lit(None).cast("double"),
            "maintainability_score": F.lit(None).cast("double"),
            # as the candidates are listed
            "position": F.array_position(
                F.array(*[F.lit(n) for n in candidates.NAMES]), F.col("model")
            ).cast("int"),
        }
    )
    place = cut(ranking.ranked(table))
    better = place.select(F.col("accuracy").alias("other"), F.col("recommendation_rank").alias("rank"))
    behind = (F.col("recommendation_rank") > F.col("rank")) & (F.col("accuracy") > F.col("other"))
    wrong = place.join(F.broadcast(better), behind, "left_semi").select("model", F.lit(True).alias("wrong"))
    shares = ["accuracy", "f1_weighted", "f1_macro", "top_2_accuracy"]
    fine = F.col("mcc").between(-1, 1) & F.col("cohen_kappa").between(-1, 1)
    for share in shares:
        fine = fine & F.col(share).between(0, 1)
    judged = place.join(wrong, "model", "left").crossJoin(F.broadcast(_majority(test)))  # one row
    return judged.select(
        "model",
        fine.alias("in_range"),
        F.col("wrong").isNull().alias("placed"),
        "majority",
        (F.col("accuracy") >= F.col("majority") + MARGIN).alias("above_majority"),
    )


EPOCHS = 6


@query(
    "train_epochs",
    f"""SELECT CAST(epoch AS INT) AS epoch, (SELECT count(*) FROM {KNOWN_SQL} WHERE doc_id % 5 <> 0) AS n_train,
        {MAJORITY_SQL} AS majority, TRUE AS loss_fell, TRUE AS above_majority, TRUE AS f1_recomputed, TRUE AS timed
    FROM range(1, {EPOCHS + 1}) e(epoch)""",
)
def train_epochs(spark, sf):
    """The history of mini-batch training: the loss below that of the first epoch, and the held-out
    accuracy above the majority class by MARGIN, in every epoch from the second; the best epoch's
    weights, read back from their checkpoint, score the held-out rows to the weighted F1 of the
    history."""
    rows = cut(b.letter_shares(spark, sf).withColumnRenamed("embedding", "features"))
    train, test = _split(rows)
    fitted = training.fit_epochs(train, test, len(b.LANGS), epochs=EPOCHS)
    fitted.weights = training.load(spark, fitted.checkpoints[fitted.best_epoch])
    quality = evaluation.quality_metrics(training.score(test, fitted)).select(F.col("f1_weighted").alias("again"))
    log = training.as_run_log(fitted.history, "run")
    timed = log.filter("key = 'epoch_time_sec'").select(F.col("step").alias("epoch"), (F.col("value") > 0).alias("timed"))
    loss = F.first("train_loss").over(Window.orderBy("epoch"))  # one row an epoch
    best = F.lit(fitted.best_epoch)
    return (
        fitted.history.withColumn("first_loss", loss)
        .join(timed, "epoch")
        .crossJoin(F.broadcast(_majority(test)))
        .crossJoin(F.broadcast(quality))
        .crossJoin(F.broadcast(train.agg(F.count("*").alias("n_train"))))
        .select(
            "epoch",
            "n_train",
            "majority",
            ((F.col("epoch") == 1) | (F.col("train_loss") < F.col("first_loss"))).alias("loss_fell"),
            ((F.col("epoch") == 1) | (F.col("val_acc") >= F.col("majority") + MARGIN)).alias("above_majority"),
            ((F.col("epoch") != best) | (F.col("val_f1_weighted") == F.col("again"))).alias("f1_recomputed"),
            "timed",
        )
    )
