import pytest
from pyspark.sql import functions as F

from assaykit.operators import evaluation, ranking, runs
from assaykit.sources import files

# Published numbers: confusion matrices and the metrics stated for them.
MATRICES = {
    "mobilenet_v3_small": [[16, 1, 0, 1, 0], [2, 16, 0, 1, 1], [2, 0, 13, 1, 2], [3, 0, 1, 17, 0], [0, 4, 2, 0, 13]],
    "efficientnet_b0": [[17, 1, 0, 0, 0], [1, 18, 0, 0, 1], [0, 2, 16, 0, 0], [1, 0, 0, 20, 0], [1, 5, 0, 0, 13]],
    "resnet18": [[16, 1, 0, 0, 1], [4, 12, 1, 0, 3], [2, 1, 13, 1, 1], [2, 0, 0, 19, 0], [1, 2, 1, 1, 14]],
}
METRICS = {
    "mobilenet_v3_small": (0.7812, 0.7808, 0.7796, 0.7284, 0.7265),
    "efficientnet_b0": (0.875, 0.8766, 0.8764, 0.8476, 0.8435),
    "resnet18": (0.7708, 0.7699, 0.7681, 0.7172, 0.7136),
}
COSTS = {
    134.5: (0.7435, 0.07138, 7.4349, 74.3494, 743.4944),
    84.4: (1.1848, 0.11374, 11.8483, 118.4834, 1184.8341),
    127.2: (0.7862, 0.07547, 7.8616, 78.6164, 786.1635),
}
COMPARISON = """model,version_tag,accuracy,latency_mean_ms,throughput_img_per_sec,cost_per_1k_dkk,maintainability_score
mobilenet_v3_small,cleaned_v1,0.7812,7.434,134.5,0.7435,5.0
efficientnet_b0,cleaned_v1,0.875,11.85,84.4,1.1848,4.2
resnet18,cleaned_v1,0.7708,7.859,127.2,0.7862,3.4
"""


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [
        (model, label, pred)
        for model, matrix in MATRICES.items()
        for label, line in enumerate(matrix)
        for pred, n in enumerate(line)
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "model string, label int, pred int")


def test_published_metrics(predictions):
    for row in evaluation.quality_metrics(predictions).collect():
        assert tuple(row)[1:] == METRICS[row["model"]]


def test_matrix_is_dense_and_sums_to_support(predictions):
    matrix = evaluation.confusion_matrix(predictions, 6)
    assert matrix.count() == 3 * 36
    nested = {r["model"]: r["matrix"] for r in evaluation.matrix_rows(matrix).collect()}
    for model, want in MATRICES.items():
        assert [line[:5] for line in nested[model][:5]] == want
        assert nested[model][5] == [0] * 6


def test_single_class_has_no_division_by_zero(spark):
    one = spark.createDataFrame([("m", 1, 1), ("m", 1, 1)], "model string, label int, pred int")
    row = evaluation.quality_metrics(one).first()
    assert (row["accuracy"], row["mcc"], row["cohen_kappa"]) == (1.0, 0.0, None)


def test_published_costs(spark):
    rows = spark.createDataFrame([(t,) for t in COSTS], "t double")
    for row in evaluation.cost_model(rows, "t", F.lit(96)).collect():
        got = tuple(row[c] for c in ("cost_per_1k_images_dkk", "cost_for_test_set_dkk", "cost_scale_10k_dkk", "cost_scale_100k_dkk", "cost_scale_1M_dkk"))
        assert got == COSTS[row["t"]]


def test_zero_throughput_fails(spark):
    rows = spark.createDataFrame([(0.0,)], "t double")
    with pytest.raises(Exception, match="must be > 0"):
        evaluation.cost_model(rows, "t", F.lit(1)).collect()


def test_published_maintainability(spark):
    params = [("a", 1522981), ("b", 4013953), ("c", 11179077)]
    rows = spark.createDataFrame([(m, n, n, 1) for m, n in params], "model string, total_params long, trainable_params long, dependency_count int")
    got = {r["model"]: (r["maintainability_score"], r["param_count_M"]) for r in evaluation.maintainability(rows).collect()}
    assert got == {"a": (5.0, 1.523), "b": (4.2, 4.014), "c": (3.4, 11.179)}


def test_published_ranking(spark, tmp_path):
    path = tmp_path / "model_comparison_cleaned_v1.csv"
    path.write_text(COMPARISON)
    rows = files.comparison_csv(spark, str(path), "cleaned_v9").withColumn("comparison_id", F.lit("c"))
    ranked = ranking.ranked(rows)
    order = [(r["model"], r["overall_score"]) for r in ranked.orderBy("recommendation_rank").collect()]
    # 0.45175 is stored a little below the tie
    assert order == [("mobilenet_v3_small", 0.775), ("resnet18", 0.4517), ("efficientnet_b0", 0.375)]
    found = ranking.recommendation(ranked).first()
    assert (found["recommended_model"], found["runner_up_model"]) == ("mobilenet_v3_small", "resnet18")
    assert found["reasoning"][0] == ranking.REASON_CLEAR and len(found["reasoning"]) == 3
    assert found["dataset_version_tag"] == "cleaned_v1"


CANDIDATE = "comparison_id string, model string, version_tag string, accuracy double, latency_mean_ms double, cost_per_1k_images_dkk double, maintainability_score double, position int"


def test_ranking_edges(spark):
    rows = [
        ("x", "a", "v", 0.5, 1.0, 1.0, None, 0),
        ("x", "b", "v", 0.5, 0.0, 1.0, None, 1),
        ("x", "c", "v", 0.5, 0.0, 1.0, None, 2),
        ("y", "d", "v", None, None, None, None, 0),
    ]
    ranked = {r["model"]: r for r in ranking.ranked(spark.createDataFrame(rows, CANDIDATE)).collect()}
    # no range gives 1; a missing value 0; the better latency of b and c is 0.0, and they tie in order
    assert (ranked["a"]["quality_score"], ranked["a"]["upkeep_score"]) == (1.0, 0.0)
    assert [ranked[m]["recommendation_rank"] for m in "bca"] == [1, 2, 3]
    assert (ranked["d"]["overall_score"], ranked["d"]["recommendation_rank"]) == (0.0, 1)
    alone = ranking.recommendation(ranking.ranked(spark.createDataFrame(rows[3:], CANDIDATE))).first()
    assert alone["runner_up_model"] is None and alone["reasoning"] == []


def test_best_epoch_is_the_first_maximum(spark):
    rows = [("m", 1, 0.2), ("m", 2, 0.7), ("m", 3, 0.7), ("z", 1, 0.0), ("z", 2, 0.0)]
    frame = spark.createDataFrame(rows, "model string, epoch int, acc double")
    got = {r["model"]: (r["best_epoch"], r["best_acc"]) for r in runs.best_epoch(frame).collect()}
    assert got == {"m": (2, 0.7), "z": (0, 0.0)}
    assert [r["epoch"] for r in runs.running_best(frame).orderBy("epoch").collect()] == [1, 2]


def test_no_runs_gives_one_row(spark):
    shape = "run_id string, model string, version_tag string, scoring_version string, start_time long, accuracy double, latency_mean_ms double, cost_per_1k_images_dkk double, maintainability_score double"
    nothing = spark.createDataFrame([], shape)
    winner = spark.createDataFrame([("w",)], "recommended_model string")
    row = runs.dashboard_summary(nothing, winner, "e", "t", "v2").first()
    assert row["total_runs"] == 0 and row["latest_run_time"] is None
    assert row["recommended_model"] is None and row["scoring_version"] == "v2"
