import random
import struct
import subprocess
import sys
import zlib
from pathlib import Path

from pyspark.sql import functions as F

from assaykit.functions import numeric, paths
from assaykit.operators import images, index, runs, versions
from assaykit.sources import files, runstore, tables


def png(width, height, pixel):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + bytes(v for x in range(width) for v in pixel(x, y)) for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_image_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    noise = random.Random(0)
    (tmp_path / "a/noise.png").write_bytes(png(20, 10, lambda x, y: [noise.randrange(256)] * 3))
    (tmp_path / "a/black.png").write_bytes(png(16, 16, lambda x, y: (0, 0, 0)))
    (tmp_path / "white.png").write_bytes(png(16, 16, lambda x, y: (255, 255, 255)))
    (tmp_path / "broken.png").write_bytes(b"\x89PNG\r\n\x1a\nnot really")
    found = files.image_files(spark, str(tmp_path))
    heads = {Path(r["path"]).name: r for r in images.image_headers(found).collect()}
    assert len(heads) == 4
    noise_row = heads["noise.png"]
    assert (noise_row["width"], noise_row["height"], noise_row["channels"]) == (20, 10, 3)
    assert (noise_row["image_mode"], noise_row["image_format"]) == ("RGB", "PNG")
    assert {n: r["is_corrupt"] for n, r in heads.items()} == {
        "noise.png": 0, "black.png": 0, "white.png": 0, "broken.png": 1,
    }
    stats = {Path(r["path"]).name: r for r in images.pixel_stats(found).collect()}
    assert set(stats) == {"noise.png", "black.png", "white.png"}
    assert stats["black.png"]["is_dark_issue"] and not stats["noise.png"]["is_dark_issue"]
    assert stats["white.png"]["is_light_issue"] and stats["white.png"]["is_low_information_issue"]
    assert not stats["noise.png"]["is_blurry_issue"]
    same = images.same_hash_sizes(images.perceptual_hash(found)).collect()
    assert [r["group_size"] for r in same] == [2]  # both flat images have no block above the mean


def test_line_list_keeps_file_order(spark, tmp_path):
    for name, n in (("train.txt", 4000), ("test.txt", 900)):
        lines = [f"c{i % 3}/f_{i}.JPG" if i % 7 else "   " for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        listed = (
            files.line_list(spark, str(tmp_path))
            .withColumn("split", F.regexp_extract(F.input_file_name(), r"(\w+)\.txt", 1))
            .withColumn("class_name", paths.first_component(F.col("value")))
        )
        counted = index.per_class_counter(listed, block=F.shiftright("line_no", 33)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {(r["split"], r["value"]): r["counter"] for r in counted}
    for name, n in (("train", 4000), ("test", 900)):
        seen = {}
        for i in range(n):
            if i % 7:
                cls = f"c{i % 3}"
                seen[cls] = seen.get(cls, 0) + 1
                assert got[(name, f"{cls}/f_{i}.JPG")] == seen[cls]


def test_names(spark):
    rows = spark.createDataFrame(
        [(1_234_567, "a/b/.hidden"), (7, "x/y.tar.PNG"), (8, "net_a_cleaned_v1_cleaned.pt"), (9, "plain.pt"), (10, "cleaned_v2.pt"), (11, "uncleaned_v2.pt")],
        "n int, p string",
    )
    got = {
        r["n"]: r
        for r in rows.select(
            "n",
            paths.item_id(F.lit("train"), F.lit("c"), F.col("n")).alias("id"),
            paths.suffix_lower(paths.basename(F.col("p"))).alias("suffix"),
            paths.artifact_model(F.col("p")).alias("model"),
            paths.artifact_tag(F.col("p")).alias("tag"),
            paths.relative_to(F.lit("C:\\data\\img\\a.png"), "C:\\data").alias("rel"),
        ).collect()
    }
    assert got[1_234_567]["id"] == "train_c_1234567" and got[7]["id"] == "train_c_000007"
    assert got[1_234_567]["suffix"] == "" and got[7]["suffix"] == ".png"
    assert (got[8]["model"], got[8]["tag"]) == ("net_a", "cleaned_v1_cleaned")
    assert (got[9]["model"], got[9]["tag"]) == ("plain", "unknown")
    assert (got[10]["model"], got[10]["tag"]) == ("", "cleaned_v2")
    assert (got[11]["model"], got[11]["tag"]) == ("uncleaned_v2", "unknown")
    assert got[7]["rel"] == "img/a.png"


def test_rounding_is_that_of_python(spark):
    rng = random.Random(4)
    values = [k / 96 for k in range(97)] + [rng.randrange(40000) * 0.25 / 1e4 for _ in range(500)]
    values += [-v for v in values[:40]] + [1e9 + 0.00005, 12345.67885]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select("v", numeric.half_even(F.col("v"), 4).alias("r")).collect()
    assert all(r["r"] == round(r["v"], 4) for r in got)


def test_tolerant_numbers(spark):
    rows = spark.createDataFrame([("",), ("x",), (" 1.5 ",), ("5.0",), (None,)], "v string")
    got = rows.select(numeric.safe_round(F.col("v")).alias("d"), numeric.safe_long(F.col("v")).alias("n")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), (1.5, 1), (5.0, 5), (None, None)]
    iso = spark.range(1).select(numeric.millis_to_iso(F.lit(1780079029830)).alias("i")).first()["i"]
    assert iso == "2026-05-29T18:23:49.830000+00:00"


def test_run_store(spark, tmp_path):
    run = tmp_path / "866" / "r1"
    (run / "metrics").mkdir(parents=True)
    (run / "params").mkdir()
    (tmp_path / "866" / "meta.yaml").write_text("experiment_id: '866'\nname: rooms\n")
    (run / "meta.yaml").write_text("run_id: r1\nrun_name: one\nstart_time: 1780079029830\nend_time: null\nstatus: 3\n")
    (run / "metrics" / "final_accuracy").write_text("1780079219948 0.7708 0\n1780079219948 0.7708 0\n")
    (run / "metrics" / "best_epoch").write_text("1 3 0\n2 13 1\n")
    (run / "params" / "model").write_text("resnet18")
    log = runstore.run_log(spark, str(tmp_path))
    meta = runstore.run_meta(spark, str(tmp_path))
    wide = runs.runs_wide(log, meta).collect()
    assert len(wide) == 1
    row = wide[0]
    assert (row["run_id"], row["model"], row["accuracy"], row["best_epoch"]) == ("r1", "resnet18", 0.7708, 13.0)
    assert row["start_time"] == 1780079029830 and row["mcc"] is None
    experiments = runstore.experiment_meta(spark, str(tmp_path))
    assert runs.of_experiment(meta, experiments, "rooms").count() == 1
    assert runs.of_experiment(meta, experiments, "other").count() == 0


def test_pointers_listing_and_reports(spark, tmp_path):
    (tmp_path / "raw.dvc").write_text("outs:\n- md5: 50d8bf7a.dir\n  size: 1\n")
    (tmp_path / "empty.dvc").write_text("outs: []\n")
    got = {r["name"]: r["md5"] for r in files.read_pointers(spark, str(tmp_path)).collect()}
    assert got == {"raw": "50d8bf7a", "empty": None}
    (tmp_path / "deep").mkdir()
    for name in ("a.JPG", "b.webp", "c.txt", "net_cleaned_v1.pt"):
        (tmp_path / "deep" / name).write_bytes(b"x")
    listing = files.file_listing(spark, str(tmp_path))
    assert files.count_images(listing).first()["n_images"] == 2
    assert [tuple(r) for r in files.model_files(listing).collect()] == [("net_cleaned_v1.pt", "net", "cleaned_v1")]
    assert files.latest_artifact(listing, "raw.dvc").first()["name"] == "raw.dvc"
    texts = spark.createDataFrame([('{"model": "m", "version_tag": "t", "quality": {"accuracy": 0.5}}',), ("not json",)], "value string")
    meta = files.report_meta(files.parse_reports(texts).select("report.*"))
    arts = spark.createDataFrame([("m", "t"), ("n", "t")], "model_name string, version_tag string")
    shown = {r["model_name"]: (r["accuracy"], r["latency_mean_ms"]) for r in files.with_report_meta(arts, meta).collect()}
    assert shown == {"m": (0.5, 0.0), "n": (0.0, 0.0)}


def test_manifest_ignores_order_and_sees_change(spark):
    rows = [(f"d/{i}", i, f"{i:064x}") for i in range(50)]
    shape = "path string, size long, sha256 string"
    first = versions.manifest_hash(spark.createDataFrame(rows, shape)).first()[0]
    again = versions.manifest_hash(spark.createDataFrame(rows[::-1], shape).repartition(3)).first()[0]
    other = versions.manifest_hash(spark.createDataFrame([("d/0", 1, "0")] + rows[1:], shape)).first()[0]
    assert first == again != other


def test_managed_table_refresh_is_idempotent(spark):
    from assaykit.schemas import VERSIONS

    name = "assay_versions_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert tables.create_if_missing(spark, name, VERSIONS)
    assert not tables.create_if_missing(spark, name, VERSIONS)
    rows = spark.createDataFrame([(1, "v1")], "version_id int, version_tag string")
    for _ in range(2):
        tables.refresh(rows, name, VERSIONS)
        assert spark.table(name).count() == 1
    assert spark.table(name).columns == VERSIONS.fieldNames()
    spark.sql(f"DROP TABLE {name}")


def test_catalog_loads_without_a_session():
    root = Path(__file__).resolve().parents[1]
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_rounding_and_time_edges(spark):
    rows = spark.createDataFrame(
        [(float("inf"), 0), (float("-inf"), 1), (2.675, 1_780_079_029_000), (None, 1_780_079_029_123)], "v double, ms long"
    )
    got = rows.select(numeric.half_even(F.col("v"), 2).alias("r"), numeric.millis_to_iso(F.col("ms")).alias("t")).collect()
    assert [r.r for r in got] == [float("inf"), float("-inf"), 2.67, None]
    assert [r.t for r in got] == [
        "1970-01-01T00:00:00+00:00", "1970-01-01T00:00:00.001000+00:00",
        "2026-05-29T18:23:49+00:00", "2026-05-29T18:23:49.123000+00:00",
    ]
