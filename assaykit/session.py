"""Session settings and the shared folder that jobs use to cut lineage and hand tables over."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "assaykit", **conf: str) -> SparkSession:
    """A session for tests and the local bench; on a cluster the submitter makes it."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="assaykit-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/assaykit/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: no lineage, exact size statistics,
    column pruning for the steps that follow, and nothing to recompute when an executor is lost."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
