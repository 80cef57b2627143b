"""Declared shapes of the tables and documents the jobs read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


def shape(text: str, **nested: T.DataType) -> T.StructType:
    """A struct from `name type` pairs, without needing a session; `nested` adds named columns."""
    fields = [part.split() for part in text.split(",")]
    flat = [T.StructField(name, _TYPES[kind]) for name, kind in fields]
    return T.StructType(flat + [T.StructField(name, kind) for name, kind in nested.items()])


# Column names, their order and types are the data contract.
INDEX = shape(
    """
    image_id string, source_dataset string, split string, class_name string, label_id int,
    original_relative_path string, raw_path string, original_filename string, new_filename string,
    width int, height int, channels int, image_mode string, image_format string,
    aspect_ratio double, pixel_count bigint, exif_tag_count int, file_size_bytes bigint,
    md5 string, ingestion_timestamp string
    """
)
ENRICHED_ONLY = shape("file_size_kb double, is_small_image int, is_odd_aspect int, is_non_rgb int")
INTEGRITY_ONLY = shape(
    """
    file_size_mb double, is_missing_core_metadata int, invalid_split int, invalid_class int,
    is_unexpected_extension int, is_zero_or_negative_size int
    """
)
IMAGES = T.StructType(INDEX.fields + ENRICHED_ONLY.fields + INTEGRITY_ONLY.fields)
VALIDATION = shape(
    """
    image_id string, raw_path string, cleaned_path string, split string, class_name string,
    is_corrupt int, is_blurry int, too_dark int, too_bright int, low_information int,
    odd_aspect_ratio int, odd_size int, is_exact_duplicate int, is_near_duplicate int,
    canonical_image_id string, duplicate_of string, duplicate_distance double,
    cross_split_duplicate int, cross_class_duplicate int, manual_review_required int,
    drop_reason string, quality_score double, blurry_score double, dark_score double,
    light_score double, low_information_score double, odd_aspect_ratio_score double,
    odd_size_score double, exact_duplicates_score double, near_duplicates_score double,
    is_valid int, validation_timestamp string
    """
)
VERSIONS = shape(
    """
    version_id int, version_tag string, raw_image_count bigint, cleaned_image_count bigint,
    raw_dvc_md5 string, cleaned_dvc_md5 string, reports_dvc_md5 string, manifest_sha256 string,
    git_commit string, created_at string, notes string
    """
)
COMPARISON = shape(
    """
    model string, version_tag string, accuracy double, f1_weighted double, f1_macro double,
    mcc double, cohen_kappa double, top_2_accuracy double, latency_mean_ms double,
    latency_p95_ms double, throughput_img_per_sec double, batch_throughput_img_s double,
    total_inference_sec double, cost_per_1k_dkk double, cost_scale_10k_dkk double,
    cost_scale_100k_dkk double, cost_scale_1M_dkk double, relative_compute_multiplier double,
    maintainability_score double, dependency_count int, param_count_M double,
    trainable_params_M double, trainable_params bigint
    """
)
HISTORY = shape(
    """
    epoch int, train_loss double, train_acc double, val_loss double, val_acc double,
    val_f1_weighted double
    """
)
RUN_LOG = shape(
    "experiment string, run_id string, kind string, key string, step bigint, ts bigint, value string"
)
REPORT = shape(
    "model string, version_tag string, run_id string, trained_at string, scoring_version string",
    quality=shape(
        """
        accuracy double, f1_weighted double, f1_macro double, mcc double, cohen_kappa double,
        top_2_accuracy double
        """,
        confusion_matrix=T.ArrayType(T.ArrayType(T.IntegerType())),
    ),
    performance=shape(
        """
        latency_mean_ms double, latency_p50_ms double, latency_p95_ms double, latency_p99_ms double,
        throughput_img_per_sec double, batch_throughput_img_per_sec double,
        total_inference_sec double
        """
    ),
    cost=shape(
        """
        cost_per_1k_images_dkk double, cost_for_test_set_dkk double, cost_scale_10k_dkk double,
        cost_scale_100k_dkk double, cost_scale_1M_dkk double, relative_compute_multiplier double,
        baseline_cost_per_1k_dkk double, baseline_throughput_img_per_sec double
        """
    ),
    maintainability=shape(
        """
        maintainability_score double, param_count_M double, trainable_params_M double,
        trainable_params bigint, dependency_count int, maint_param_score_1_5 int,
        maint_trainable_score_1_5 int, maint_dependency_score_1_5 int
        """
    ),
    training_history=T.ArrayType(HISTORY),
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Declared columns the frame does not have yet (metadata only, no job)."""
    return [f.name for f in schema.fields if f.name not in df.columns]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in the declared shape: absent columns become typed nulls, extra ones go."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
