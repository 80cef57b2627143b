"""Training and scoring candidate classifiers with the ML library."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.functions.numeric import argmax, half_even, named_scores

SEED = 42
NAMES = ("logistic_regression", "random_forest", "naive_bayes")


def with_features(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def estimators(seed: int = SEED) -> dict:
    made = (
        LogisticRegression(maxIter=20, regParam=0.01),
        RandomForestClassifier(numTrees=10, maxDepth=5, seed=seed),
        NaiveBayes(modelType="gaussian"),
    )
    return dict(zip(NAMES, made, strict=True))


def train_candidates(train: DataFrame, seed: int = SEED) -> dict:
    """Fitted models by name; all see the same rows and seed."""
    return {name: est.fit(train) for name, est in estimators(seed).items()}


def batch_score(model, df: DataFrame, name: str, classes: list[str]) -> DataFrame:
    """Predicted class, its confidence and the score of every class for each row."""
    scored = model.transform(df).withColumn("probs", vector_to_array("probability"))
    best = argmax(F.col("probs"))
    labels = F.array(*[F.lit(c) for c in classes])
    return scored.select(
        F.lit(name).alias("model"),
        "item",
        "label",
        best.alias("pred"),
        F.get(labels, best).alias("predicted_class"),
        half_even(F.array_max("probs"), 4).alias("confidence"),
        named_scores(classes, F.col("probs")).alias("scores"),
        "probs",
    )


def score_all(models: dict, df: DataFrame, classes: list[str]) -> DataFrame:
    out = None
    for name, model in models.items():
        rows = batch_score(model, df, name, classes)
        out = rows if out is None else out.unionByName(rows)
    return out
