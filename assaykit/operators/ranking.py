"""Scoring and ranking of candidate models within a comparison.

A candidate row has: comparison_id, model, version_tag, accuracy, latency_mean_ms,
cost_per_1k_images_dkk, maintainability_score and position (its place in the table it came from).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit.functions.numeric import half_even
from assaykit.operators.skew import attach, blocked_row_number

# Measures, weights, tie rules and texts of a recommendation.
MEASURES = {
    "quality_score": ("accuracy", True),
    "latency_score": ("latency_mean_ms", False),
    "cost_score": ("cost_per_1k_images_dkk", False),
    "upkeep_score": ("maintainability_score", True),
}
WEIGHT = 0.25
NO_LATENCY = 10.0**9
CLEAR_MARGIN = 0.05
MAX_REASONS = 3
REASON_TRADE_OFF = "Best overall trade-off between accuracy and latency"
REASON_COST = "Competitive deployment cost among shortlisted models"
REASON_UPKEEP = "Strong maintainability signal from a relatively small parameter footprint"
REASON_CLEAR = "Clear overall choice across quality, latency, cost, and maintainability"
DECISION_RULE = "Balanced score using quality, latency, cost, and maintainability"


def minmax(
    df: DataFrame,
    measures: dict[str, tuple[str, bool]] = MEASURES,
    total: int | None = None,
) -> DataFrame:
    """Each measure scaled to 0..1 over its comparison, 4 digits. A range of zero gives 1, a missing
    value 0. `total` is the number of candidates where it is known."""
    extremes = []
    for name, (column, _) in measures.items():
        extremes += [F.min(column).alias(f"_lo_{name}"), F.max(column).alias(f"_hi_{name}")]
    bounds = df.groupBy("comparison_id").agg(F.count("*").alias("_rows"), *extremes)
    joined = attach(df, bounds, "comparison_id", F.col("position"), size="_rows", total=total)

    def scaled(name: str, column: str, high: bool) -> Column:
        v, lo, hi = F.col(column), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        gain = (v - lo) if high else (hi - v)
        return (
            F.when(v.isNull(), 0.0)
            .when(hi == lo, 1.0)
            .otherwise(half_even(F.try_divide(gain, hi - lo), 4))
        )

    return joined.withColumns(
        {name: scaled(name, column, high) for name, (column, high) in measures.items()}
    ).drop("_rows", *[f"_{end}_{name}" for name in measures for end in ("lo", "hi")])


def score_models(df: DataFrame, total: int | None = None) -> DataFrame:
    """Adds the four scores and their equally weighted overall score."""
    overall = F.lit(0.0)
    for name in MEASURES:
        overall = overall + F.col(name) * WEIGHT
    return minmax(df, total=total).withColumn("overall_score", half_even(overall, 4))


def rank_models(scored: DataFrame) -> DataFrame:
    """Adds recommendation_rank, 1..n per comparison: overall score, then accuracy, then latency
    (missing or zero counts as slowest), then position.

    The overall score has four digits, so it splits a comparison into at most 10,001 blocks.
    """
    order = [
        F.desc("overall_score"),
        F.desc(F.coalesce("accuracy", F.lit(0.0))),
        F.asc(F.coalesce(F.nullif("latency_mean_ms", F.lit(0.0)), F.lit(NO_LATENCY))),
        F.asc("position"),
    ]
    return blocked_row_number(
        scored, ["comparison_id"], -F.col("overall_score"), order, "recommendation_rank"
    )


def ranked(df: DataFrame, total: int | None = None) -> DataFrame:
    return rank_models(score_models(df, total))


def top_two(ranked_models: DataFrame) -> DataFrame:
    """One row per comparison with its winner and runner-up as structs."""
    winner_and_next = ranked_models.filter("recommendation_rank <= 2")
    row = F.struct(*[c for c in ranked_models.columns if c != "comparison_id"])
    return winner_and_next.groupBy("comparison_id").agg(
        F.max(F.when(F.col("recommendation_rank") == 1, row)).alias("top"),
        F.max(F.when(F.col("recommendation_rank") == 2, row)).alias("second"),
    )


def score_margin(ranked_models: DataFrame) -> DataFrame:
    pairs = top_two(ranked_models)
    margin = F.col("top.overall_score") - F.col("second.overall_score")
    return pairs.select(
        "comparison_id",
        F.col("top.model").alias("model"),
        F.round(margin, 4).alias("margin"),
        F.coalesce(margin >= CLEAR_MARGIN, F.lit(False)).cast("int").alias("is_clear"),
    )


def reasons(top: str = "top", second: str = "second") -> Column:
    """At most three sentences; the first becomes the clear-choice one when the margin allows."""
    known = F.array_compact(
        F.array(
            F.when(
                F.col(f"{top}.accuracy").isNotNull() & F.col(f"{top}.latency_mean_ms").isNotNull(),
                F.lit(REASON_TRADE_OFF),
            ),
            F.when(F.col(f"{top}.cost_per_1k_images_dkk").isNotNull(), F.lit(REASON_COST)),
            F.when(F.col(f"{top}.maintainability_score").isNotNull(), F.lit(REASON_UPKEEP)),
        )
    )
    margin = F.col(f"{top}.overall_score") - F.col(f"{second}.overall_score")
    clear = F.coalesce(margin >= CLEAR_MARGIN, F.lit(False))
    led = F.when(
        clear, F.concat(F.array(F.lit(REASON_CLEAR)), F.slice(known, 2, MAX_REASONS))
    ).otherwise(known)
    return F.slice(led, 1, MAX_REASONS)


def recommendation(ranked_models: DataFrame, scoring_version: str = "v2") -> DataFrame:
    return top_two(ranked_models).select(
        "comparison_id",
        F.col("top.model").alias("recommended_model"),
        F.col("top.version_tag").alias("dataset_version_tag"),
        F.lit(scoring_version).alias("scoring_version"),
        F.lit(DECISION_RULE).alias("decision_rule"),
        reasons().alias("reasoning"),
        F.col("second.model").alias("runner_up_model"),
    )


def recommended_with_score(ranked_models: DataFrame) -> DataFrame:
    """One row: winner and its overall score over one comparison, nulls when there is none."""
    best = F.col("recommendation_rank") == 1
    return ranked_models.agg(
        F.max(F.when(best, F.col("model"))).alias("recommended_model"),
        F.max(F.when(best, F.col("overall_score"))).alias("overall_score"),
    )


def models_compare(ranked_models: DataFrame, latest_runs: DataFrame) -> DataFrame:
    """The ranked table with the newest run of each model."""
    return ranked_models.join(latest_runs, "model", "left").orderBy(
        "comparison_id", "recommendation_rank"
    )


def resolve_active(
    ranked_models: DataFrame, artifacts: DataFrame, default_model: str, default_tag: str
) -> DataFrame:
    """The choice to serve: the recommendation if its artifact is there, else the default if that
    is, else nulls. One row with the source of the choice."""
    spark = ranked_models.sparkSession
    fallback = spark.range(1).select(
        F.lit(default_model).alias("model_name"),
        F.lit(default_tag).alias("version_tag"),
        F.lit("env_fallback").alias("source"),
        F.lit(2).alias("place"),
    )
    wanted = ranked_models.filter("recommendation_rank = 1").select(
        F.col("model").alias("model_name"),
        F.coalesce("version_tag", F.lit(default_tag)).alias("version_tag"),
        F.lit("dashboard_recommendation").alias("source"),
        F.lit(1).alias("place"),
    )
    there = wanted.unionByName(fallback).join(
        artifacts.select("model_name", "version_tag"), ["model_name", "version_tag"], "left_semi"
    )
    pick = there.agg(
        F.min_by(F.struct("model_name", "version_tag", "source"), "place").alias("p")
    )
    return pick.select("p.model_name", "p.version_tag", "p.source")


def resolve_requests(
    requests: DataFrame, artifacts: DataFrame, active_model: str, active_tag: str
) -> DataFrame:
    """Per request the asked model and tag, else the active ones, and whether the artifact exists."""
    filled = requests.withColumns(
        {
            "model_name": F.coalesce(F.nullif("model_name", F.lit("")), F.lit(active_model)),
            "version_tag": F.coalesce(F.nullif("version_tag", F.lit("")), F.lit(active_tag)),
        }
    )
    choice = F.concat_ws("\u0001", "model_name", "version_tag").alias("_choice")
    known = artifacts.select(choice).distinct().withColumn("_there", F.lit(1))
    # most requests may name the active model, so its key is split like any hot one
    asked = filled.select("*", choice)
    return (
        attach(asked, known, "_choice", F.struct(*requests.columns), how="left")
        .withColumn("found", F.coalesce("_there", F.lit(0)))
        .drop("_there", "_choice")
    )


# Content types accepted for scoring.
MEDIA_TYPES = ["image/jpeg", "image/jpg", "image/png", "image/webp"]


def split_uploads(uploads: DataFrame) -> DataFrame:
    """Adds `rejected`: null for an accepted upload, else the reason."""
    return uploads.withColumn(
        "rejected",
        F.when(~F.coalesce(F.col("media_type").isin(MEDIA_TYPES), F.lit(False)), "unsupported_type")
        .when(F.coalesce("size", F.lit(0)) == 0, "empty"),
    )
