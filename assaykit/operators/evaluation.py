"""Evaluation of predictions: (model, label, pred, probs) rows in, metric tables out.

Everything after the confusion counts works on at most models × classes² rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.functions.numeric import bucket_1_5, half_even, ratio
from assaykit.operators.quantiles import exact_percentiles

# Cost baseline, maintainability rubric and the published formulas.
BASELINE_COST_PER_1K = 1.0
BASELINE_THROUGHPUT = 100.0
PARAM_BOUNDS_M = (3.0, 6.0, 12.0, 20.0)
DEPENDENCY_BOUNDS = (1, 2, 3, 4)
MAINTAINABILITY_WEIGHTS = {"param_count": 0.4, "trainable_params": 0.4, "dependency_count": 0.2}
DEFAULT_DEPENDENCIES = 1
SCORING_VERSION = "v2"


def confusion_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model", "label", "pred").agg(F.count("*").alias("n"))


def confusion_matrix(predictions: DataFrame, classes: int) -> DataFrame:
    """Dense counts: one row per model, label and predicted class."""
    ids = F.sequence(F.lit(0), F.lit(classes - 1))
    counts = confusion_counts(predictions)
    grid = (
        counts.select("model")
        .distinct()
        .withColumn("label", F.explode(ids))
        .withColumn("pred", F.explode(ids))
    )
    return grid.join(counts, ["model", "label", "pred"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """The matrix as nested arrays, one row per model (classes² numbers)."""
    rows = matrix.groupBy("model", "label").agg(
        F.sort_array(F.collect_list(F.struct("pred", F.col("n").cast("int").alias("n")))).alias("r")
    )
    return rows.groupBy("model").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("label", F.col("r.n").alias("n")))),
            lambda x: x["n"],
        ).alias("matrix")
    )


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model").agg(
        half_even(F.avg((F.col("label") == F.col("pred")).cast("double")), 4).alias("accuracy")
    )


def class_marginals(counts: DataFrame) -> DataFrame:
    """Per model and class: true count, predicted count and hits; classes seen on either side."""
    n = F.col("n")
    hit = F.when(F.col("label") == F.col("pred"), n).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label").alias("cls"), n.alias("t"), F.lit(0).cast("bigint").alias("p"), hit.alias("h")),
        F.struct(F.col("pred").alias("cls"), F.lit(0).cast("bigint").alias("t"), n.alias("p"), F.lit(0).cast("bigint").alias("h")),
    )
    return (
        counts.select("model", F.inline(sides))
        .groupBy("model", "cls")
        .agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("hits"))
    )


def _class_scores(marginals: DataFrame) -> DataFrame:
    hits = F.col("hits").cast("double")
    return marginals.select(
        "model",
        "cls",
        "support",
        "predicted",
        "hits",
        ratio(hits, F.col("predicted")).alias("precision"),
        ratio(hits, F.col("support")).alias("recall"),
        ratio(2 * hits, F.col("predicted") + F.col("support")).alias("f1"),
    )


def per_class_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages and accuracy;
    not rounded."""
    scores = _class_scores(class_marginals(confusion_counts(predictions))).withColumnRenamed("f1", "f1-score")
    measures = ["precision", "recall", "f1-score"]
    rows = scores.select(
        "model", F.col("cls").cast("string").alias("entry"), *measures, "support"
    )
    macro = scores.groupBy("model").agg(
        F.lit("macro avg").alias("entry"),
        *[F.avg(m).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    weighted = scores.groupBy("model").agg(
        F.lit("weighted avg").alias("entry"),
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    overall = F.sum("hits") / F.sum("support")
    total = scores.groupBy("model").agg(
        F.lit("accuracy").alias("entry"),
        *[overall.alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    table = rows.unionByName(macro).unionByName(weighted).unionByName(total)
    return table.select(
        "model", "entry", *measures, "support"
    )


def quality_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, weighted and macro F1, Matthews correlation and Cohen's kappa from one scan."""
    return metrics_from_counts(confusion_counts(predictions))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    scores = _class_scores(class_marginals(counts))
    t, p = F.col("support").cast("double"), F.col("predicted").cast("double")
    sums = scores.groupBy("model").agg(
        F.sum("hits").cast("double").alias("c"),
        F.sum(t).alias("s"),
        F.sum(t * p).alias("tp"),
        F.sum(t * t).alias("tt"),
        F.sum(p * p).alias("pp"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * t) / F.sum(t)).alias("f1_weighted"),
    )
    c, s, tp, tt, pp = (F.col(x) for x in ("c", "s", "tp", "tt", "pp"))
    spread = F.sqrt((s * s - pp) * (s * s - tt))
    return sums.select(
        "model",
        half_even(c / s, 4).alias("accuracy"),
        half_even(F.col("f1_weighted"), 4).alias("f1_weighted"),
        half_even(F.col("f1_macro"), 4).alias("f1_macro"),
        half_even(ratio(c * s - tp, spread), 4).alias("mcc"),
        half_even(F.try_divide(c * s - tp, F.nullif(s * s - tp, F.lit(0.0))), 4).alias("cohen_kappa"),
    )


def top2_accuracy(predictions: DataFrame) -> DataFrame:
    """Share of rows whose true class has fewer than two strictly higher probabilities."""
    mine = F.get("probs", F.col("label"))
    above = F.size(F.filter("probs", lambda x: x > mine))
    return predictions.groupBy("model").agg(
        half_even(F.avg((above < 2).cast("double")), 4).alias("top_2_accuracy")
    )


def latency_profile(samples: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, exact p50 / p95 / p99 and items per second from millisecond samples."""
    means = samples.groupBy(key).agg(F.avg(value).alias("_mean"))
    marks = exact_percentiles(samples, key, value, [0.5, 0.95, 0.99], ["p50", "p95", "p99"])
    return means.join(marks, key).select(
        key,
        half_even(F.col("_mean"), 3).alias("latency_mean_ms"),
        *[half_even(F.col(p), 3).alias(f"latency_{p}_ms") for p in ("p50", "p95", "p99")],
        half_even(F.try_divide(F.lit(1000.0), F.col("_mean")), 1).alias("throughput_img_per_sec"),
    )


def batch_throughput(batches: DataFrame, key: str) -> DataFrame:
    """Items over elapsed seconds from batch rows (n, begin_s, end_s)."""
    return (
        batches.groupBy(key)
        .agg(F.sum("n").alias("_n"), (F.max("end_s") - F.min("begin_s")).alias("_t"))
        .select(
            key,
            half_even(F.try_divide(F.col("_n"), F.col("_t")), 1).alias("batch_throughput_img_per_sec"),
            half_even(F.col("_t"), 4).alias("total_inference_sec"),
        )
    )


def guard_positive(value: Column, name: str) -> Column:
    """The value; the job fails when it is not above zero."""
    return F.when(value > 0, value).otherwise(
        F.raise_error(F.lit(f"{name} must be > 0")).cast("double")
    )


def cost_model(
    df: DataFrame,
    throughput: str,
    n_images: Column,
    base_cost: float = BASELINE_COST_PER_1K,
    base_throughput: float = BASELINE_THROUGHPUT,
) -> DataFrame:
    """Relative cost columns from throughput against the baseline."""
    slow = F.lit(base_throughput) / guard_positive(F.col(throughput), throughput)
    per_1k = F.lit(base_cost) * slow
    return df.withColumns(
        {
            "cost_per_1k_images_dkk": half_even(per_1k, 4),
            "cost_for_test_set_dkk": half_even(per_1k * n_images / 1000, 5),
            "cost_scale_10k_dkk": half_even(per_1k * 10, 4),
            "cost_scale_100k_dkk": half_even(per_1k * 100, 4),
            "cost_scale_1M_dkk": half_even(per_1k * 1000, 4),
            "relative_compute_multiplier": half_even(slow, 4),
            "baseline_cost_per_1k_dkk": half_even(F.lit(base_cost), 4),
            "baseline_throughput_img_per_sec": half_even(F.lit(base_throughput), 4),
        }
    )


def total_params(tensors: DataFrame) -> DataFrame:
    """Parameter counts per model from its tensor list (numel, trainable)."""
    return tensors.groupBy("model").agg(
        F.sum("numel").cast("bigint").alias("total_params"),
        F.coalesce(F.sum(F.when(F.col("trainable"), F.col("numel"))), F.lit(0))
        .cast("bigint")
        .alias("trainable_params"),
    )


def maintainability(params: DataFrame) -> DataFrame:
    """Rubric score from total_params, trainable_params and dependency_count."""
    total_m = F.col("total_params") / 1_000_000
    trainable_m = F.col("trainable_params") / 1_000_000
    deps = F.coalesce("dependency_count", F.lit(DEFAULT_DEPENDENCIES))
    scored = params.withColumns(
        {
            "param_count_M": half_even(total_m, 3),
            "trainable_params_M": half_even(trainable_m, 3),
            "dependency_count": deps,
            "maint_param_score_1_5": bucket_1_5(total_m, PARAM_BOUNDS_M),
            "maint_trainable_score_1_5": bucket_1_5(trainable_m, PARAM_BOUNDS_M),
            "maint_dependency_score_1_5": bucket_1_5(deps, DEPENDENCY_BOUNDS),
        }
    )
    w = MAINTAINABILITY_WEIGHTS
    return scored.withColumn(
        "maintainability_score",
        half_even(
            F.lit(w["param_count"]) * F.col("maint_param_score_1_5")
            + F.lit(w["trainable_params"]) * F.col("maint_trainable_score_1_5")
            + F.lit(w["dependency_count"]) * F.col("maint_dependency_score_1_5"),
            3,
        ),
    )


def weighted_means(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean loss and accuracy over batches of different sizes (loss, n, correct)."""
    return batches.groupBy(*keys).agg(
        (F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("loss"),
        (F.sum("correct") / F.sum("n")).alias("acc"),
    )


def epoch_history(batches: DataFrame) -> DataFrame:
    """Rounded loss and accuracy per model, epoch and phase ('train' / 'val'), side by side."""

    def mean(what: str, phase: str) -> Column:
        mine = F.col("phase") == phase
        return F.sum(F.when(mine, F.col(what))) / F.sum(F.when(mine, F.col("n")))

    rows = batches.withColumn("lost", F.col("loss") * F.col("n"))
    return rows.groupBy("model", "epoch").agg(
        half_even(mean("lost", "train"), 5).alias("train_loss"),
        half_even(mean("correct", "train"), 4).alias("train_acc"),
        half_even(mean("lost", "val"), 5).alias("val_loss"),
        half_even(mean("correct", "val"), 4).alias("val_acc"),
    )


def model_comparison(reports: DataFrame) -> DataFrame:
    """One flat row per nested report."""
    q = ["accuracy", "f1_weighted", "f1_macro", "mcc", "cohen_kappa", "top_2_accuracy"]
    return reports.select(
        "model",
        "version_tag",
        *[F.col(f"quality.{c}") for c in q],
        "performance.latency_mean_ms",
        "performance.latency_p95_ms",
        "performance.throughput_img_per_sec",
        F.col("performance.batch_throughput_img_per_sec").alias("batch_throughput_img_s"),
        "performance.total_inference_sec",
        F.col("cost.cost_per_1k_images_dkk").alias("cost_per_1k_dkk"),
        "cost.cost_scale_10k_dkk",
        "cost.cost_scale_100k_dkk",
        "cost.cost_scale_1M_dkk",
        "cost.relative_compute_multiplier",
        "maintainability.maintainability_score",
        "maintainability.dependency_count",
        "maintainability.param_count_M",
        "maintainability.trainable_params_M",
        "maintainability.trainable_params",
    )
