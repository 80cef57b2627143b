"""The registered queries of these operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.llm import (
    chat,
    clustering,
    contamination,
    divergence,
    idfiles,
    jaccard,
    languages,
    minhash,
    packing,
    secrets,
    sql,
    substrings,
    urls,
    vectors,
)
from assaykit.session import cut, scratch_path
from assaykit.sources.tables import parquet

Query = Callable[[SparkSession, str], DataFrame]

#: A conversation whose texts hold the control strings of common templates.
PROBE = r"\### Assistant: </turn> ok"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(parquet(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(
        parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "benchmark")
    ).drop("text_hash")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_spans(parquet(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = parquet(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    windows = cut(chat.format_conversations(turns.union(probe)))
    return chat.read_back(windows).select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    return docs.withColumn("found", languages.identify(docs)).select(
        "doc_id",
        languages.held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(parquet(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(parquet(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_inner_products(
        parquet(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0
    )


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-ids")
    idfiles.write_shards(docs, path)
    idfiles.build_index(spark, path)
    return idfiles.read_documents(spark, path, docs.select("doc_id"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.find_secrets(F.col("text"))
    docs = parquet(spark, sf_dir, "documents").select("doc_id", spans.alias("found"))
    return docs.select("doc_id", *[c.alias(n) for n, c in secrets.report(F.col("found")).items()])


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(parquet(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.with_digests(*clustering.cluster(parquet(spark, sf_dir, "embeddings")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(parquet(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_decontamination,
        op3_substring_dedup,
        op4_chat_formatting,
        op5_language_id,
        op6_jaccard_join,
        op7_packing,
        op8_exact_top_k,
        op9_token_ids,
        op10_secret_scan,
        op11_minhash_near_dedup,
        op12_centroid_clustering,
        op13_source_divergence,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": sql.URL_FILTER,
    "op2_decontamination": sql.CONTAMINATION,
    "op4_chat_formatting": sql.CHAT_FORMATTING,
    "op8_exact_top_k": sql.EXACT_TOP_K,
    "op12_centroid_clustering": sql.CENTROID_CLUSTERING,
    "op13_source_divergence": sql.SOURCE_DIVERGENCE,
}
