"""Queries over the long run log and the run table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.functions.numeric import millis_to_iso, safe_long, safe_round
from assaykit.operators.skew import attach

# Fixed value: how many runs the read endpoints look at.
RUN_CAP = 200
# Metric keys of a run and the names they are shown under.
FLOAT_METRICS = {
    "accuracy": "final_accuracy",
    "f1_weighted": "final_f1_weighted",
    "f1_macro": "final_f1_macro",
    "mcc": "final_mcc",
    "cohen_kappa": "final_cohen_kappa",
    "top_2_accuracy": "final_top2_accuracy",
    "best_val_acc": "best_val_acc",
    "best_epoch": "best_epoch",
    "latency_mean_ms": "latency_mean_ms",
    "latency_p50_ms": "latency_p50_ms",
    "latency_p95_ms": "latency_p95_ms",
    "latency_p99_ms": "latency_p99_ms",
    "throughput_img_per_sec": "throughput_img_per_sec",
    "batch_throughput_img_per_sec": "batch_throughput_img_per_sec",
    "total_inference_sec": "total_inference_sec",
    "cost_per_1k_images_dkk": "cost_per_1k_images_dkk",
    "cost_for_test_set_dkk": "cost_for_test_set_dkk",
    "cost_scale_10k_dkk": "cost_scale_10k_dkk",
    "cost_scale_100k_dkk": "cost_scale_100k_dkk",
    "cost_scale_1M_dkk": "cost_scale_1M_dkk",
    "relative_compute_multiplier": "relative_compute_multiplier",
    "baseline_cost_per_1k_dkk": "baseline_cost_per_1k_dkk",
    "baseline_throughput_img_per_sec": "baseline_throughput_img_per_sec",
    "maintainability_score": "maintainability_score",
    "param_count_M": "param_count_M",
    "trainable_params_M": "trainable_params_M",
}
INT_METRICS = {
    "trainable_params": "trainable_params",
    "dependency_count": "dependency_count",
    "maint_param_score_1_5": "maint_param_score_1_5",
    "maint_trainable_score_1_5": "maint_trainable_score_1_5",
    "maint_dependency_score_1_5": "maint_dependency_score_1_5",
}
RUN_PARAMS = {
    "model": "model",
    "version_tag": "dataset_version_tag",
    "git_commit": "git_commit",
    "scoring_version": "scoring_version",
}
COMPACT = [
    "run_id",
    "model",
    "version_tag",
    "scoring_version",
    "start_time",
    "accuracy",
    "latency_mean_ms",
    "cost_per_1k_images_dkk",
    "maintainability_score",
]
BEST_BY = {
    "best_model_by_accuracy": ("accuracy", True),
    "best_model_by_latency": ("latency_mean_ms", False),
    "best_model_by_cost": ("cost_per_1k_images_dkk", False),
    "best_model_by_maintainability": ("maintainability_score", True),
}


def of_experiment(runs: DataFrame, experiments: DataFrame, name: str) -> DataFrame:
    """Runs of the experiment with that name; none when it does not exist."""
    named = experiments.filter(F.col("name") == name).select("experiment").distinct()
    return attach(runs, named, "experiment", F.col("run_id"), how="left_semi")


def latest_values(log: DataFrame) -> DataFrame:
    """Last value of each key of each run by step, then time, then value."""
    newest = F.struct("step", "ts", F.col("value").try_cast("double").alias("v"), F.col("value").alias("t"))
    return log.groupBy("run_id", "kind", "key").agg(F.max_by("value", newest).alias("value"))


def _pivot(values: DataFrame, kind: str, names: dict[str, str]) -> list:
    return [
        F.max(F.when((F.col("kind") == kind) & (F.col("key") == key), F.col("value"))).alias(name)
        for name, key in names.items()
    ]


def runs_wide(log: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per run: its meta fields, four parameters and the metric columns."""
    values = latest_values(log)
    text = values.groupBy("run_id").agg(
        *_pivot(values, "param", RUN_PARAMS),
        *_pivot(values, "metric", {**FLOAT_METRICS, **INT_METRICS}),
    )
    typed = text.select(
        "run_id",
        *RUN_PARAMS,
        *[safe_round(F.col(c)).alias(c) for c in FLOAT_METRICS],
        *[safe_long(F.col(c)).alias(c) for c in INT_METRICS],
    )
    return meta.select("run_id", "run_name", "status", "start_time").join(typed, "run_id", "left")


def runs_compact(wide: DataFrame) -> DataFrame:
    return wide.select(*COMPACT)


def run_count(runs: DataFrame, cap: int = RUN_CAP) -> DataFrame:
    """One row: `total_runs` as the capped endpoint reports it, and `all_runs` there are."""
    n = F.count("*")
    return runs.agg(F.least(n, F.lit(cap)).alias("total_runs"), n.alias("all_runs"))


def newest(runs: DataFrame, n: int) -> DataFrame:
    """The n latest runs; a top-n over partial top-n lists, no full sort."""
    return runs.orderBy(F.desc_nulls_last("start_time"), F.asc("run_id")).limit(n)


def list_runs(wide: DataFrame, limit: int = 20) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit is 1 to 100")
    return newest(wide, limit).withColumn("start_time", millis_to_iso(F.col("start_time")))


def latest_per_model(runs: DataFrame) -> DataFrame:
    """(model, latest_run_id); equal start times go to the smaller run id."""
    first = F.struct(F.col("start_time").isNull(), -F.col("start_time"), F.col("run_id"))
    return (
        runs.filter(F.coalesce("model", F.lit("")) != "")
        .groupBy("model")
        .agg(F.min_by("run_id", first).alias("latest_run_id"))
    )


def best_by(runs: DataFrame, metric: str, higher: bool = True, name: str = "model") -> DataFrame:
    """One row: the model of the run with the best value, the newest run on ties."""
    return runs.agg(_best(metric, higher).alias(name))


def _best(metric: str, higher: bool):
    value = F.col(metric)
    place = F.struct(
        (-value if higher else value).alias("v"),
        F.col("start_time").isNull().alias("n"),
        (-F.col("start_time")).alias("s"),
        F.col("run_id").alias("r"),
    )
    return F.min_by("model", F.when(value.isNotNull(), place))


def dashboard_summary(
    runs: DataFrame,
    recommended: DataFrame,
    experiment: str,
    tag: str | None,
    scoring_version: str,
    cap: int = RUN_CAP,
) -> DataFrame:
    """One row over the newest runs; all but the names is null or 0 without any. `recommended` has
    at most one row with recommended_model."""
    kept = newest(runs, cap)
    first = F.struct(F.col("start_time").isNull(), -F.col("start_time"), F.col("run_id"))
    found = F.count("*") > 0
    winner = recommended.agg(F.max("recommended_model").alias("m")).scalar()
    return (
        kept.agg(
            F.count("*").alias("total_runs"),
            F.max("start_time").alias("_latest"),
            F.min_by("version_tag", first).alias("_tag"),
            F.min_by("scoring_version", first).alias("_scoring"),
            *[_best(metric, higher).alias(name) for name, (metric, higher) in BEST_BY.items()],
        )
        .select(
            F.lit(experiment).alias("experiment_name"),
            F.coalesce(F.nullif(F.lit(tag), F.lit("")), "_tag").alias("dataset_version_tag"),
            F.coalesce(F.nullif("_scoring", F.lit("")), F.lit(scoring_version)).alias(
                "scoring_version"
            ),
            "total_runs",
            millis_to_iso(F.col("_latest")).alias("latest_run_time"),
            *BEST_BY,
            F.when(F.col("total_runs") > 0, winner).alias("recommended_model"),
        )
    )


def running_best(epochs: DataFrame, key: str = "model", acc: str = "acc") -> DataFrame:
    """Epochs that set a new best accuracy, above 0. One row per model and epoch goes in."""
    before = (
        Window.partitionBy(key).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    )
    return epochs.withColumn("previous_best", F.coalesce(F.max(acc).over(before), F.lit(0.0))).filter(
        F.col(acc) > F.col("previous_best")
    )


def best_epoch(epochs: DataFrame, key: str = "model", acc: str = "acc") -> DataFrame:
    """First epoch that reaches the maximum; epoch 0 and accuracy 0 when none is above 0."""
    above = F.col(acc) > 0
    return epochs.groupBy(key).agg(
        F.coalesce(
            F.min_by("epoch", F.when(above, F.struct(-F.col(acc), F.col("epoch")))), F.lit(0)
        ).alias("best_epoch"),
        F.coalesce(F.max(F.when(above, F.col(acc))), F.lit(0.0)).alias("best_acc"),
    )


def tags_in_order(sources: Sequence[DataFrame], column: str = "version_tag") -> DataFrame:
    """Distinct non-empty tags of several lists; earlier lists first, by name within a list."""
    tagged = None
    for place, source in enumerate(sources):
        rows = source.select(F.col(column).alias("version_tag"), F.lit(place).alias("place"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return (
        tagged.filter(F.coalesce("version_tag", F.lit("")) != "")
        .groupBy("version_tag")
        .agg(F.min("place").alias("place"))
        .orderBy("place", "version_tag")
    )
