"""Queries over predictions, batches, runs and candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaykit.functions import numeric
from assaykit.operators import evaluation, ranking, runs
from assaykit.plans import bindings as b
from assaykit.plans.catalog import query
from assaykit.session import cut
from assaykit.sources import files, tables

SCORED = ("scored",)
CLS = ("cls",)
RUNS = ("runs",)
RANKED = ("ranked",)

# --- predictions -------------------------------------------------------------------------------


@query(
    "softmax_scores",
    """SELECT item, 'k' || k AS class_name, pround(probs[k + 1], 4) AS confidence
    FROM scored, range(10) r(k)""",
    SCORED,
)
def softmax_scores(spark, sf):
    named = numeric.named_scores(b.PRED_CLASSES, F.col("probs"))
    return b.predictions(spark, sf).select("item", F.inline(named))


@query(
    "argmax_class",
    """SELECT item, pred, 'k' || pred AS predicted_class, pround(list_max(probs), 4) AS confidence
    FROM scored""",
    SCORED,
)
def argmax_class(spark, sf):
    names = F.array(*[F.lit(c) for c in b.PRED_CLASSES])
    best = numeric.argmax(F.col("probs"))
    return b.predictions(spark, sf).select(
        "item",
        best.alias("pred"),
        F.get(names, best).alias("predicted_class"),
        numeric.half_even(F.array_max("probs"), 4).alias("confidence"),
    )


@query(
    "confusion_matrix",
    """, m AS (SELECT DISTINCT model FROM scored)
    SELECT m.model, CAST(l.k AS INTEGER) AS label, CAST(p.k AS INTEGER) AS pred, coalesce(n, 0) AS n
    FROM m CROSS JOIN range(10) l(k) CROSS JOIN range(10) p(k)
    LEFT JOIN conf c ON c.model = m.model AND c.label = l.k AND c.pred = p.k""",
    ("conf",),
)
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(b.predictions(spark, sf), 10)


@query(
    "accuracy",
    """SELECT model, pround(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 4) AS accuracy
    FROM scored GROUP BY model""",
    SCORED,
)
def accuracy(spark, sf):
    return evaluation.accuracy(b.predictions(spark, sf))


@query(
    "per_class_report",
    """SELECT model, CAST(cls AS VARCHAR) AS entry, prec AS precision, rec AS recall,
        f1 AS "f1-score", CAST(support AS BIGINT) AS support FROM cls
    UNION ALL SELECT model, 'macro avg', avg(prec), avg(rec), avg(f1),
        CAST(sum(support) AS BIGINT) FROM cls GROUP BY model
    UNION ALL SELECT model, 'weighted avg', sum(prec * support) / sum(support),
        sum(rec * support) / sum(support), sum(f1 * support) / sum(support),
        CAST(sum(support) AS BIGINT) FROM cls GROUP BY model
    UNION ALL SELECT model, 'accuracy', sum(hits) / sum(support),
        sum(hits) / sum(support), sum(hits) / sum(support),
        CAST(sum(support) AS BIGINT) FROM cls GROUP BY model""",
    CLS,
)
def per_class_report(spark, sf):
    return evaluation.per_class_report(b.predictions(spark, sf))


METRIC_SQL = {
    "f1_weighted": "pround(sum(f1 * support) / sum(support), 4)",
    "f1_macro": "pround(avg(f1), 4)",
    "mcc": """pround((sum(hits) * sum(support) - sum(support * predicted))
        / sqrt((sum(support) ** 2 - sum(predicted * predicted))
             * (sum(support) ** 2 - sum(support * support))), 4)""",
    "cohen_kappa": """pround((sum(hits) * sum(support) - sum(support * predicted))
        / (sum(support) ** 2 - sum(support * predicted)), 4)""",
}


def _one_metric(name: str) -> None:
    @query(name, f"SELECT model, {METRIC_SQL[name]} AS {name} FROM cls GROUP BY model", CLS)
    def metric(spark, sf):
        return evaluation.quality_metrics(b.predictions(spark, sf)).select("model", name)


for _name in METRIC_SQL:
    _one_metric(_name)


@query(
    "top2_accuracy",
    """SELECT model, pround(avg(CASE WHEN len(list_filter(probs, lambda x: x > probs[label + 1])) < 2
        THEN 1.0 ELSE 0.0 END), 4) AS top_2_accuracy FROM scored GROUP BY model""",
    SCORED,
)
def top2_accuracy(spark, sf):
    return evaluation.top2_accuracy(b.predictions(spark, sf))


@query(
    "latency_profile",
    """SELECT event_type, pround(avg(value), 3) AS latency_mean_ms,
        pround(quantile_cont(value, 0.5), 3) AS latency_p50_ms,
        pround(quantile_cont(value, 0.95), 3) AS latency_p95_ms,
        pround(quantile_cont(value, 0.99), 3) AS latency_p99_ms,
        pround(1000 / avg(value), 1) AS throughput_img_per_sec FROM events GROUP BY event_type""",
)
def latency_profile(spark, sf):
    return evaluation.latency_profile(tables.parquet(spark, sf, "events"), "event_type", "value")


@query(
    "batch_throughput",
    """SELECT model, pround(sum(n) / (max(end_s) - min(begin_s)), 1) AS batch_throughput_img_per_sec,
        pround(max(end_s) - min(begin_s), 4) AS total_inference_sec FROM batches GROUP BY model""",
    ("batches",),
)
def batch_throughput(spark, sf):
    return evaluation.batch_throughput(b.batches(spark, sf), "model")


COST_COLUMNS = [
    "cost_per_1k_images_dkk",
    "cost_for_test_set_dkk",
    "cost_scale_10k_dkk",
    "cost_scale_100k_dkk",
    "cost_scale_1M_dkk",
    "relative_compute_multiplier",
]


@query(
    "cost_model",
    """, t AS (SELECT comparison_id, model, 100 / latency_mean_ms AS k, position FROM cand
        WHERE latency_mean_ms > 0)
    SELECT model, pround(k, 4) AS cost_per_1k_images_dkk,
        pround(k * position / 1000, 5) AS cost_for_test_set_dkk, pround(k * 10, 4) AS cost_scale_10k_dkk,
        pround(k * 100, 4) AS cost_scale_100k_dkk, pround(k * 1000, 4) AS "cost_scale_1M_dkk",
        pround(k, 4) AS relative_compute_multiplier FROM t""",
    ("cand",),
)
def cost_model(spark, sf):
    timed = b.candidates(spark, sf).filter("latency_mean_ms > 0").drop("cost_per_1k_images_dkk")
    return evaluation.cost_model(timed, "latency_mean_ms", F.col("position")).select(
        "model", *COST_COLUMNS
    )


def _bucket(value: str) -> str:
    return f"""CASE WHEN {value} <= 3 THEN 5 WHEN {value} <= 6 THEN 4 WHEN {value} <= 12 THEN 3
        WHEN {value} <= 20 THEN 2 ELSE 1 END"""


@query(
    "maintainability",
    f""", s AS (SELECT *, total_params / 1000000 AS m, trainable_params / 1000000 AS t,
            CAST(substr(model, 4) AS INTEGER) % 5 + 1 AS deps FROM params),
    b AS (SELECT *, {_bucket('m')} AS pm, {_bucket('t')} AS pt, CASE WHEN deps <= 1 THEN 5
        WHEN deps <= 2 THEN 4 WHEN deps <= 3 THEN 3 WHEN deps <= 4 THEN 2 ELSE 1 END AS pd FROM s)
    SELECT model, pround(CAST(0.4 AS DOUBLE) * pm + CAST(0.4 AS DOUBLE) * pt + CAST(0.2 AS DOUBLE) * pd, 3)
        AS maintainability_score, pround(m, 3) AS "param_count_M", pround(t, 3) AS "trainable_params_M",
        deps AS dependency_count, pm AS maint_param_score_1_5, pt AS maint_trainable_score_1_5,
        pd AS maint_dependency_score_1_5 FROM b""",
    ("params",),
)
def maintainability(spark, sf):
    params = evaluation.total_params(b.tensors(spark, sf)).withColumn(
        "dependency_count", F.substring("model", 4, 2).cast("int") % 5 + 1
    )
    return evaluation.maintainability(params).select(
        "model",
        "maintainability_score",
        "param_count_M",
        "trainable_params_M",
        "dependency_count",
        "maint_param_score_1_5",
        "maint_trainable_score_1_5",
        "maint_dependency_score_1_5",
    )


@query("total_params", "SELECT model, total_params, trainable_params FROM params", ("params",))
def total_params(spark, sf):
    return evaluation.total_params(b.tensors(spark, sf))


@query(
    "weighted_mean_loss",
    """SELECT model, round(sum(loss * n) / sum(n), 6) AS loss, round(sum(correct) / sum(n), 6) AS acc
    FROM batches GROUP BY model""",
    ("batches",),
)
def weighted_mean_loss(spark, sf):
    return evaluation.weighted_means(b.batches(spark, sf), ["model"]).select(
        "model", F.round("loss", 6).alias("loss"), F.round("acc", 6).alias("acc")
    )


HISTORY_SQL = """SELECT model, epoch,
    pround(sum(loss * n) FILTER (phase = 'train') / sum(n) FILTER (phase = 'train'), 5) AS train_loss,
    pround(sum(correct) FILTER (phase = 'train') / sum(n) FILTER (phase = 'train'), 4) AS train_acc,
    pround(sum(loss * n) FILTER (phase = 'val') / sum(n) FILTER (phase = 'val'), 5) AS val_loss,
    pround(sum(correct) FILTER (phase = 'val') / sum(n) FILTER (phase = 'val'), 4) AS val_acc
    FROM batches GROUP BY model, epoch"""


@query("epoch_history", HISTORY_SQL, ("batches",))
def epoch_history(spark, sf):
    return evaluation.epoch_history(b.batches(spark, sf))


@query(
    "running_best",
    """SELECT model, epoch, acc, previous_best FROM (SELECT *, coalesce(max(acc) OVER (PARTITION BY model
        ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS previous_best
        FROM epochs) WHERE acc > previous_best""",
    ("epochs",),
)
def running_best(spark, sf):
    return runs.running_best(b.epochs(spark, sf))


@query(
    "best_epoch",
    """SELECT model, epoch AS best_epoch, acc AS best_acc FROM epochs QUALIFY row_number() OVER (
        PARTITION BY model ORDER BY acc DESC, epoch) = 1""",
    ("epochs",),
)
def best_epoch(spark, sf):
    return runs.best_epoch(b.epochs(spark, sf))


def report_rows(spark, sf):
    """Evaluation reports assembled from the prediction, latency, cost and parameter tables. Models
    meet by number: prediction models m0..m2, the latency of the event types m0..m4 and the net tensors
    m0..m6. A model that lacks a part has nulls for it."""
    quality = evaluation.quality_metrics(b.predictions(spark, sf)).join(
        evaluation.top2_accuracy(b.predictions(spark, sf)), "model"
    )
    name = F.col("event_type")
    number = F.lit(None).cast("string")
    for place, kind in enumerate(("click", "view", "error", "purchase", "signup")):
        number = F.when(name == kind, f"m{place}").otherwise(number)
    latency = (
        evaluation.latency_profile(tables.parquet(spark, sf, "events"), "event_type", "value")
        .withColumn("model", number)
        .drop("event_type")
    )
    cost = evaluation.cost_model(
        latency.select("model", "throughput_img_per_sec"), "throughput_img_per_sec", F.lit(96)
    ).drop("throughput_img_per_sec")
    upkeep = evaluation.maintainability(
        evaluation.total_params(b.tensors(spark, sf))
        .withColumn("model", F.replace("model", F.lit("net"), F.lit("m")))
        .withColumn("dependency_count", F.lit(1))
    )

    def pack(df, name):
        columns = [c for c in df.columns if c != "model"]
        return df.select("model", F.struct(*columns).alias(name))

    joined = pack(quality, "quality")
    for frame, name in ((latency, "performance"), (cost, "cost"), (upkeep, "maintainability")):
        joined = joined.join(pack(frame, name), "model", "full")
    return joined.withColumns(
        {
            "version_tag": F.lit("cleaned_v1"),
            "performance": F.col("performance")
            .withField("batch_throughput_img_per_sec", F.col("performance.throughput_img_per_sec"))
            .withField("total_inference_sec", F.col("performance.latency_mean_ms")),
        }
    )


MODEL_OF = """CASE event_type WHEN 'click' THEN 'm0' WHEN 'view' THEN 'm1' WHEN 'error' THEN 'm2'
        WHEN 'purchase' THEN 'm3' WHEN 'signup' THEN 'm4' END"""

COMPARISON_SQL = f""", lat AS (SELECT {MODEL_OF} AS model, pround(avg(value), 3) AS mean_ms,
        pround(quantile_cont(value, 0.95), 3) AS p95, pround(1000 / avg(value), 1) AS tp
    FROM events GROUP BY event_type),
met AS (SELECT model, pround(sum(hits) / sum(support), 4) AS accuracy,
        {', '.join(f'{v} AS {k}' for k, v in METRIC_SQL.items())} FROM cls GROUP BY model),
top2 AS (SELECT model, pround(avg(CASE WHEN len(list_filter(probs, lambda x: x > probs[label + 1])) < 2
        THEN 1.0 ELSE 0.0 END), 4) AS top_2_accuracy FROM scored GROUP BY model),
p AS (SELECT replace(model, 'net', 'm') AS model, total_params / 1000000 AS m,
        trainable_params / 1000000 AS t, trainable_params FROM params)
SELECT model, 'cleaned_v1' AS version_tag, accuracy, f1_weighted, f1_macro, mcc, cohen_kappa,
    top_2_accuracy, mean_ms AS latency_mean_ms, p95 AS latency_p95_ms, tp AS throughput_img_per_sec,
    tp AS batch_throughput_img_s, mean_ms AS total_inference_sec, pround(100 / tp, 4) AS cost_per_1k_dkk,
    pround(100 / tp * 10, 4) AS cost_scale_10k_dkk, pround(100 / tp * 100, 4) AS cost_scale_100k_dkk,
    pround(100 / tp * 1000, 4) AS "cost_scale_1M_dkk", pround(100 / tp, 4) AS relative_compute_multiplier,
    pround(CAST(0.4 AS DOUBLE) * ({_bucket('m')}) + CAST(0.4 AS DOUBLE) * ({_bucket('t')})
        + CAST(0.2 AS DOUBLE) * 5, 3) AS maintainability_score,
    1 AS dependency_count, pround(m, 3) AS "param_count_M", pround(t, 3) AS "trainable_params_M",
    trainable_params
FROM (SELECT model FROM met UNION SELECT model FROM lat UNION SELECT model FROM p) every
LEFT JOIN met USING (model) LEFT JOIN top2 USING (model) LEFT JOIN lat USING (model)
LEFT JOIN p USING (model)"""


@query("model_comparison", COMPARISON_SQL, ("cls", "scored", "params"))
def model_comparison(spark, sf):
    return evaluation.model_comparison(report_rows(spark, sf))


@query(
    "rename_flatten",
    """SELECT model, pround(sum(hits) / sum(support), 4) AS accuracy, 'cleaned_v1' AS version_tag
    FROM params p LEFT JOIN cls ON cls.model = replace(p.model, 'net', 'm')
    GROUP BY p.model""".replace("SELECT model", "SELECT replace(p.model, 'net', 'm') AS model"),
    ("cls", "params"),
)
def rename_flatten(spark, sf):
    return evaluation.model_comparison(report_rows(spark, sf)).select(
        "model", "accuracy", "version_tag"
    )


# --- runs --------------------------------------------------------------------------------------


@query(
    "lookup_experiment",
    "SELECT run_id FROM meta WHERE experiment = 'exp1'",
    ("meta",),
)
def lookup_experiment(spark, sf):
    named = b.experiments(spark, sf)
    return runs.of_experiment(b.run_meta(spark, sf), named, "name_exp1").select("run_id")


@query("latest_metric_value", "SELECT run_id, key, value FROM latest", ("latest",))
def latest_metric_value(spark, sf):
    last = runs.latest_values(b.run_log(spark, sf)).filter("kind = 'metric'")
    return last.select("run_id", "key", F.col("value").cast("double").alias("value"))


def wide(spark, sf):
    meta = b.run_meta(spark, sf).select("run_id", "run_name", "status", "start_time")
    return runs.runs_wide(b.run_log(spark, sf), meta)


def newest_wide(spark, sf, meta, n: int):
    """The newest runs are chosen before the log is read for them."""
    kept = cut(runs.newest(meta, n))
    log = b.run_log(spark, sf).join(kept.select("run_id"), "run_id", "left_semi")
    return runs.runs_wide(log, kept)


ISO = """replace(strftime(make_timestamp(start_time * 1000), '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || '+00:00'"""


@query(
    "runs_wide",
    """SELECT run_id, run_name, status, start_time, model, version_tag, accuracy, latency_mean_ms,
        cost_per_1k_images_dkk, maintainability_score, trainable_params FROM runs""",
    RUNS,
)
def runs_wide(spark, sf):
    return wide(spark, sf).select(
        "run_id",
        "run_name",
        "status",
        "start_time",
        "model",
        "version_tag",
        "accuracy",
        "latency_mean_ms",
        "cost_per_1k_images_dkk",
        "maintainability_score",
        "trainable_params",
    )


@query("runs_compact", f"SELECT {', '.join(runs.COMPACT)} FROM runs", RUNS)
def runs_compact(spark, sf):
    return runs.runs_compact(wide(spark, sf))


@query(
    "recent_runs",
    f"SELECT run_id, {ISO} AS start_time, model FROM runs r ORDER BY r.start_time DESC, run_id LIMIT 20",
    RUNS,
)
def recent_runs(spark, sf):
    return runs.list_runs(newest_wide(spark, sf, b.run_meta(spark, sf), 20), 20).select(
        "run_id", "start_time", "model"
    )


@query(
    "cap_runs",
    "SELECT run_id, start_time FROM meta ORDER BY start_time DESC, run_id LIMIT 200",
    ("meta",),
)
def cap_runs(spark, sf):
    return runs.newest(b.run_meta(spark, sf), runs.RUN_CAP).select("run_id", "start_time")


@query(
    "run_count",
    "SELECT least(count(*), 200) AS total_runs, count(*) AS all_runs FROM meta",
    ("meta",),
)
def run_count(spark, sf):
    return runs.run_count(b.run_meta(spark, sf))


LATEST_SQL = """SELECT model, arg_min(run_id, {'s': -start_time, 'r': run_id}) AS latest_run_id
    FROM meta GROUP BY model"""


@query("latest_per_model", LATEST_SQL, ("meta",))
def latest_per_model(spark, sf):
    return runs.latest_per_model(b.run_meta(spark, sf))


def _best_sql(metric: str, way: str) -> str:
    return f"""(SELECT model FROM runs WHERE {metric} IS NOT NULL
        ORDER BY {metric} {way}, start_time DESC, run_id LIMIT 1)"""


@query(
    "best_by_metric",
    f"SELECT {_best_sql('accuracy', 'DESC')} AS best_high, {_best_sql('latency_mean_ms', 'ASC')} AS best_low",
    RUNS,
)
def best_by_metric(spark, sf):
    table = wide(spark, sf)
    low = runs.best_by(table, "latency_mean_ms", higher=False).scalar()
    return runs.best_by(table, "accuracy", name="best_high").withColumn("best_low", low)


@query(
    "filter_metric_not_null",
    "SELECT run_id, accuracy FROM runs WHERE accuracy IS NOT NULL",
    RUNS,
)
def filter_metric_not_null(spark, sf):
    return wide(spark, sf).filter(F.col("accuracy").isNotNull()).select("run_id", "accuracy")


@query(
    "dashboard_summary",
    f""", kept AS (SELECT * FROM runs WHERE experiment = 'exp1' ORDER BY start_time DESC, run_id LIMIT 200)
    SELECT 'name_exp1' AS experiment_name, arg_min(version_tag, {{'s': -start_time, 'r': run_id}})
            AS dataset_version_tag, 'v2' AS scoring_version, count(*) AS total_runs,
        max({ISO}) AS latest_run_time,
        {_best_sql('accuracy', 'DESC').replace('FROM runs', 'FROM kept')} AS best_model_by_accuracy,
        {_best_sql('latency_mean_ms', 'ASC').replace('FROM runs', 'FROM kept')} AS best_model_by_latency,
        {_best_sql('cost_per_1k_images_dkk', 'ASC').replace('FROM runs', 'FROM kept')}
            AS best_model_by_cost,
        {_best_sql('maintainability_score', 'DESC').replace('FROM runs', 'FROM kept')}
            AS best_model_by_maintainability,
        (SELECT model FROM ranked WHERE comparison_id = 'even' AND recommendation_rank = 1)
            AS recommended_model,
        (SELECT count(*) FROM meta WHERE experiment = 'exp1') AS all_runs FROM kept""",
    ("runs", "ranked", "meta"),
)
def dashboard_summary(spark, sf):
    even = ranked(spark, sf).filter("comparison_id = 'even'")
    name = "name_exp1"
    meta = runs.of_experiment(b.run_meta(spark, sf), b.experiments(spark, sf), name)
    newest = newest_wide(spark, sf, meta, runs.RUN_CAP)
    summary = runs.dashboard_summary(newest, ranking.recommended_with_score(even), name, "", "v2")
    return summary.withColumn("all_runs", runs.run_count(meta).select("all_runs").scalar())


def ranked(spark, sf):
    """The candidates, written once, in their ranking order."""
    table = cut(b.candidates(spark, sf))
    return ranking.ranked(table, table.count())


# --- ranking -----------------------------------------------------------------------------------


@query(
    "scan_comparison_csv",
    """SELECT model, 'cleaned_v1' AS version_tag, accuracy, latency_mean_ms, cost_per_1k_images_dkk,
        maintainability_score FROM cand""",
    ("cand",),
)
def scan_comparison_csv(spark, sf):
    """The candidate table written as CSV with its stored column name and an empty tag, then read
    back tolerantly."""
    from assaykit.session import scratch_path
    from assaykit.sources import sinks

    path = scratch_path(spark, "model_comparison_cleaned_v1.csv")
    stored = b.candidates(spark, sf).withColumnRenamed("cost_per_1k_images_dkk", "cost_per_1k_dkk")
    sinks.summary_csv(stored.withColumn("version_tag", F.lit("")), path)
    return files.comparison_csv(spark, path, "cleaned_v1").select(
        "model",
        "version_tag",
        "accuracy",
        "latency_mean_ms",
        "cost_per_1k_images_dkk",
        "maintainability_score",
    )


@query(
    "minmax_normalize_high",
    "SELECT model, CAST(quality_score AS DOUBLE) AS quality_score, CAST(upkeep_score AS DOUBLE) AS upkeep_score FROM norm",
    ("norm",),
)
def minmax_normalize_high(spark, sf):
    return ranking.minmax(b.candidates(spark, sf)).select("model", "quality_score", "upkeep_score")


@query(
    "minmax_normalize_low",
    "SELECT model, CAST(latency_score AS DOUBLE) AS latency_score, CAST(cost_score AS DOUBLE) AS cost_score FROM norm",
    ("norm",),
)
def minmax_normalize_low(spark, sf):
    return ranking.minmax(b.candidates(spark, sf)).select("model", "latency_score", "cost_score")


@query(
    "score_models",
    """SELECT model, quality_score, latency_score, cost_score, upkeep_score, overall_score
    FROM ranked""",
    RANKED,
)
def score_models(spark, sf):
    return ranking.score_models(b.candidates(spark, sf)).select(
        "model", "quality_score", "latency_score", "cost_score", "upkeep_score", "overall_score"
    )


@query(
    "recommendation_rank",
    "SELECT comparison_id, model, overall_score, recommendation_rank FROM ranked",
    RANKED,
)
def recommendation_rank(spark, sf):
    return ranked(spark, sf).select(
        "comparison_id", "model", "overall_score", "recommendation_rank"
    )


PAIR = """, pair AS (SELECT t.*, s.model AS second_model, s.overall_score AS second_score
    FROM ranked t LEFT JOIN ranked s ON s.comparison_id = t.comparison_id AND s.recommendation_rank = 2
    WHERE t.recommendation_rank = 1)"""


@query(
    "score_margin",
    PAIR
    + """ SELECT comparison_id, model, round(overall_score - second_score, 4) AS margin,
        CASE WHEN overall_score - second_score >= 0.05 THEN 1 ELSE 0 END AS is_clear FROM pair""",
    RANKED,
)
def score_margin(spark, sf):
    return ranking.score_margin(ranked(spark, sf))


@query(
    "runner_up",
    PAIR + " SELECT comparison_id, second_model AS runner_up_model FROM pair",
    RANKED,
)
def runner_up(spark, sf):
    pairs = ranking.top_two(ranked(spark, sf))
    return pairs.select("comparison_id", F.col("second.model").alias("runner_up_model"))


COMPARE_SQL = f""", newest AS ({LATEST_SQL.replace('FROM meta', "FROM (SELECT run_id, start_time, 'Brand#' || (user_key % 30) AS model FROM (SELECT *, CAST(substr(run_id, 5) AS INTEGER) AS user_key FROM meta))")})
    SELECT r.comparison_id, r.model, n.latest_run_id, r.accuracy, r.f1_weighted, r.latency_mean_ms,
        r.throughput_img_per_sec, r.cost_per_1k_images_dkk, r.maintainability_score,
        r."param_count_M", r.recommendation_rank FROM ranked r LEFT JOIN newest n ON n.model = r.model"""


def brand_runs(spark, sf):
    """Runs under the brand names of the candidates."""
    number = F.substring("run_id", 5, 12).cast("int") % 30
    return b.run_meta(spark, sf).withColumn(
        "model", F.concat(F.lit("Brand#"), number.cast("string"))
    )


@query("models_compare", COMPARE_SQL, ("ranked", "meta"))
def models_compare(spark, sf):
    latest = runs.latest_per_model(brand_runs(spark, sf))
    return ranking.models_compare(ranked(spark, sf), latest).select(
        "comparison_id",
        "model",
        "latest_run_id",
        "accuracy",
        "f1_weighted",
        "latency_mean_ms",
        "throughput_img_per_sec",
        "cost_per_1k_images_dkk",
        "maintainability_score",
        "param_count_M",
        "recommendation_rank",
    )


@query(
    "join_latest_run",
    COMPARE_SQL.replace(
        'r.comparison_id, r.model, n.latest_run_id, r.accuracy, r.f1_weighted, r.latency_mean_ms,\n'
        '        r.throughput_img_per_sec, r.cost_per_1k_images_dkk, r.maintainability_score,\n'
        '        r."param_count_M", r.recommendation_rank',
        "r.model, n.latest_run_id",
    ).replace("FROM ranked r", "FROM cand r"),
    ("cand", "meta"),
)
def join_latest_run(spark, sf):
    latest = runs.latest_per_model(brand_runs(spark, sf))
    return b.candidates(spark, sf).join(latest, "model", "left").select("model", "latest_run_id")


REASON_SQL = f"""array_to_string(list_filter([
    CASE WHEN overall_score - second_score >= 0.05 THEN '{ranking.REASON_CLEAR}'
        WHEN accuracy IS NOT NULL AND latency_mean_ms IS NOT NULL THEN '{ranking.REASON_TRADE_OFF}' END,
    CASE WHEN cost_per_1k_images_dkk IS NOT NULL THEN '{ranking.REASON_COST}' END,
    CASE WHEN maintainability_score IS NOT NULL THEN '{ranking.REASON_UPKEEP}' END],
    lambda x: x IS NOT NULL), '; ')"""


@query(
    "recommendation",
    PAIR
    + f""" SELECT comparison_id, model AS recommended_model, version_tag AS dataset_version_tag,
        'v2' AS scoring_version, '{ranking.DECISION_RULE}' AS decision_rule, {REASON_SQL} AS reasoning,
        second_model AS runner_up_model FROM pair""",
    RANKED,
)
def recommendation(spark, sf):
    found = ranking.recommendation(ranked(spark, sf))
    return found.withColumn("reasoning", F.array_join("reasoning", "; "))


@query("reasoning", PAIR + f" SELECT comparison_id, {REASON_SQL} AS reasoning FROM pair", RANKED)
def reasoning(spark, sf):
    pairs = ranking.top_two(ranked(spark, sf))
    return pairs.select("comparison_id", F.array_join(ranking.reasons(), "; ").alias("reasoning"))


@query(
    "top_k_slice",
    """SELECT comparison_id, array_to_string(list(model ORDER BY recommendation_rank), ',') AS top_models
    FROM ranked WHERE recommendation_rank <= 3 GROUP BY comparison_id""",
    RANKED,
)
def top_k_slice(spark, sf):
    first = ranked(spark, sf).filter(
        F.col("recommendation_rank") <= ranking.MAX_REASONS
    )
    places = F.sort_array(F.collect_list(F.struct("recommendation_rank", "model")))
    return first.groupBy("comparison_id").agg(
        F.array_join(F.slice(places, 1, ranking.MAX_REASONS)["model"], ",").alias("top_models")
    )


@query(
    "recommended_with_score",
    """SELECT model AS recommended_model, overall_score FROM ranked WHERE comparison_id = 'odd'
        AND recommendation_rank = 1""",
    RANKED,
)
def recommended_with_score(spark, sf):
    odd = ranked(spark, sf).filter("comparison_id = 'odd'")
    return ranking.recommended_with_score(odd)


def stored_artifacts(spark, sf):
    """Weight files by name, read as model and tag."""
    return files.model_files(b.artifacts(spark, sf))


PARSED = """, parsed AS (SELECT name, CASE WHEN position('_cleaned' IN name) > 0
        THEN substr(name, 1, position('_cleaned' IN name) - 1) ELSE replace(name, '.pt', '') END AS model,
    CASE WHEN position('_cleaned' IN name) > 0
        THEN replace(substr(name, position('_cleaned' IN name) + 1), '.pt', '') ELSE 'unknown' END AS tag
    FROM arts)"""


@query(
    "list_model_files",
    PARSED + " SELECT name AS weight_file, model AS model_name, tag AS version_tag FROM parsed ORDER BY 1",
    ("arts",),
)
def list_model_files(spark, sf):
    return stored_artifacts(spark, sf)


def report_figures(spark, sf):
    """Report figures per event type and tag, for some of the artifacts."""
    even = F.col("user_id") % 5
    return (
        tables.parquet(spark, sf, "events")
        .groupBy(
            F.concat("event_type", F.lit("_"), even.cast("string")).alias("model_name"),
            F.concat(F.lit("cleaned_v"), (F.col("user_id") % 2).cast("string")).alias("version_tag"),
        )
        .agg(
            F.avg("value").alias("accuracy"),
            F.max("value").alias("latency_mean_ms"),
            F.min("value").alias("cost_per_1k_dkk"),
            F.lit(None).cast("double").alias("maintainability_score"),
        )
    )


META_SQL = (
    PARSED
    + """, figures AS (SELECT event_type || '_' || (user_id % 5) AS model,
        'cleaned_v' || (user_id % 2) AS tag, avg(value) AS accuracy, max(value) AS latency,
        min(value) AS cost FROM events GROUP BY 1, 2)
    SELECT p.name AS weight_file, p.model AS model_name, p.tag AS version_tag,
        pround(coalesce(accuracy, 0), 3) AS accuracy, pround(coalesce(latency, 0), 3) AS latency_mean_ms,
        pround(coalesce(cost, 0), 3) AS cost_per_1k_dkk, CAST(0 AS DOUBLE) AS maintainability_score
    FROM parsed p LEFT JOIN figures f ON f.model = p.model AND f.tag = p.tag"""
)


@query("available_models", META_SQL, ("arts",))
def available_models(spark, sf):
    listed = files.with_report_meta(stored_artifacts(spark, sf), report_figures(spark, sf))
    return listed.select(
        "weight_file",
        "model_name",
        "version_tag",
        *[numeric.half_even(F.col(c), 3).alias(c) for c in files.REPORT_DEFAULTS],
    )


@query(
    "join_report_meta",
    META_SQL.replace("p.name AS weight_file, ", "").replace("pround(coalesce(cost, 0), 3)", "pround(coalesce(cost, 0), 3)"),
    ("arts",),
)
def join_report_meta(spark, sf):
    listed = files.with_report_meta(stored_artifacts(spark, sf), report_figures(spark, sf))
    return listed.select(
        "model_name", "version_tag", *[numeric.half_even(F.col(c), 3).alias(c) for c in files.REPORT_DEFAULTS]
    )


@query(
    "resolve_active_choice",
    PARSED
    + """, choice AS (SELECT model, 'dashboard_recommendation' AS source, 1 AS place FROM ranked
            WHERE comparison_id = 'odd' AND recommendation_rank = 1
        UNION ALL SELECT 'click_1', 'env_fallback', 2)
    SELECT c.model AS model_name, 'cleaned_v1' AS version_tag, c.source FROM choice c
    WHERE EXISTS (SELECT 1 FROM parsed p WHERE p.model = c.model AND p.tag = 'cleaned_v1')
    ORDER BY place LIMIT 1""",
    ("arts", "ranked"),
)
def resolve_active_choice(spark, sf):
    odd = ranked(spark, sf).filter("comparison_id = 'odd'")
    return ranking.resolve_active(odd, stored_artifacts(spark, sf), "click_1", "cleaned_v1")


@query(
    "resolve_requested_choice",
    PARSED
    + """, req AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'click_1'
            ELSE event_type || '_' || (user_id % 5) END AS model,
        CASE WHEN event_id % 4 = 0 THEN 'cleaned_v1' ELSE 'cleaned_v' || (event_id % 6) END AS tag
        FROM events)
    SELECT event_id, r.model AS model_name, r.tag AS version_tag,
        CASE WHEN EXISTS (SELECT 1 FROM parsed p WHERE p.model = r.model AND p.tag = r.tag)
            THEN 1 ELSE 0 END AS found FROM req r""",
    ("arts",),
)
def resolve_requested_choice(spark, sf):
    event = F.col("event_id")
    requests = tables.parquet(spark, sf, "events").select(
        "event_id",
        F.when(
            event % 3 != 0, F.concat("event_type", F.lit("_"), (F.col("user_id") % 5).cast("string"))
        ).alias("model_name"),
        F.when(event % 4 != 0, F.concat(F.lit("cleaned_v"), (event % 6).cast("string")))
        .otherwise("")
        .alias("version_tag"),
    )
    found = ranking.resolve_requests(
        requests, stored_artifacts(spark, sf), "click_1", "cleaned_v1"
    )
    return found.select("event_id", "model_name", "version_tag", "found")
