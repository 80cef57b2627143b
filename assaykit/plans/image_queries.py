"""Queries over image files and their hashes: written, listed and read by the executors."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from assaykit.operators import hamming, images
from assaykit.plans import bindings as b
from assaykit.plans.catalog import query
from assaykit.plans.file_queries import PIXELS
from assaykit.session import scratch_path
from assaykit.sources import files, headers, listing, tables

RADII = (0, 3, 7)
SIDE = 8


def shots(spark, sf):
    """Three images of every embedding: as it is, with two and with four pixels inverted."""
    pixel = F.transform(
        "embedding", lambda x: F.least(F.greatest(F.floor((x.cast("double") + 0.5) * 255), F.lit(0)), F.lit(255)).cast("int")
    )
    rows = (
        tables.parquet(spark, sf, "embeddings")
        .filter("label <> 9")
        .select("vec_id", pixel.alias("p"), F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k"))
    )
    turn = F.col("vec_id") % 64
    data = F.transform(
        "p", lambda v, i: F.lpad(F.hex(F.when(((i - turn + 64) * 5) % 64 < 2 * F.col("k"), 255 - v).otherwise(v)), 2, "0")
    )
    return rows.select(
        F.format_string("%06d_%d", "vec_id", "k").alias("path"),
        F.struct(
            F.lit(SIDE).alias("height"),
            F.lit(SIDE).alias("width"),
            F.lit(1).alias("nChannels"),
            F.unhex(F.array_join(data, "")).alias("data"),
        ).alias("image"),
    )


SHOT_BITS = (
    PIXELS
    + """, s AS (SELECT vec_id, k, list_transform(p, lambda v, i:
        CASE WHEN ((i - 1 - vec_id % 64 + 64) * 5) % 64 < 2 * k THEN 255 - v ELSE v END) AS p FROM px, range(3) r(k)),
    h AS (SELECT printf('%06d_%d', vec_id, k) AS path, array_to_string(
        list_transform(p, lambda x: CASE WHEN x > list_avg(p) THEN '1' ELSE '0' END), '') AS bits FROM s)"""
)


@query(
    "near_image_groups",
    SHOT_BITS.replace("WITH px", "WITH RECURSIVE px", 1)
    + f""", l AS (SELECT radius, a.path AS a, b.path AS b FROM (VALUES {", ".join(f"({r})" for r in RADII)}) r(radius),
        h a, h b WHERE a.path <> b.path AND bit_count(xor(a.bits::BIT, b.bits::BIT)) <= radius),
    reach AS (
        SELECT radius, path AS a, path AS b FROM (VALUES {", ".join(f"({r})" for r in RADII)}) r(radius), h
        UNION SELECT reach.radius, reach.a, l.b FROM reach JOIN l ON l.radius = reach.radius AND l.a = reach.b
    ), first AS (SELECT radius, a, min(b) AS first_member FROM reach GROUP BY radius, a)
    SELECT f.radius, f.a AS path, f.first_member, (SELECT count(*) FROM l WHERE l.radius = f.radius AND l.a = f.a) AS n_links,
        CAST(bit_count(xor(x.bits::BIT, y.bits::BIT)) AS INT) AS distance
    FROM first f JOIN h x ON x.path = f.a JOIN h y ON y.path = f.first_member""",
)
def near_image_groups(spark, sf):
    """Groups of images by average hash within each radius, with links and distance to the first one."""
    hashes = images.perceptual_hash(shots(spark, sf))
    out = None
    for radius in RADII:
        found = hamming.hamming_groups(hashes, radius).select(
            F.lit(radius).alias("radius"),
            "path",
            "first_member",
            "n_links",
            images.hash_distance(F.col("phash"), F.col("first_hash")).alias("distance"),
        )
        out = found if out is None else out.unionByName(found)
    return out


_BASIS = "[" + ", ".join("[" + ", ".join(repr(float(x)) for x in row) + "]" for row in images.dct_transform(SIDE)) + "]"


@query(
    "dct_hash",
    PIXELS
    + f""", t AS (SELECT {_BASIS} AS m), f AS (
        SELECT vec_id, u, v, round(sum(m[u + 1][i + 1] * p[i * 8 + j + 1] * m[v + 1][j + 1]), 6) AS c
        FROM px, t, range(8) a(u), range(8) b(v), range(8) c(i), range(8) d(j) GROUP BY vec_id, u, v
    ), m AS (SELECT vec_id, quantile_cont(c, 0.5) AS middle FROM f GROUP BY vec_id),
    bits AS (SELECT vec_id, string_agg(CASE WHEN c > middle THEN '1' ELSE '0' END, '' ORDER BY u, v) AS bits
        FROM f JOIN m USING (vec_id) GROUP BY vec_id)
    SELECT printf('images/%06d.png', vec_id) AS path, bits FROM embeddings LEFT JOIN bits USING (vec_id)""",
)
def dct_hash(spark, sf):
    hashes = images.dct_hash(b.derived_images(spark, sf))
    return hashes.select("path", F.lpad(F.bin("phash"), 64, "0").alias("bits"))


def png(width: int, height: int, grey: bytes) -> bytes:
    """A grey image as a file of the common format."""

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + grey[i * width : (i + 1) * width] for i in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def write_images(spark, sf, root):
    """One file per embedding below a folder per label: images, and for label 9 files that are cut off
    inside the header; in between, a text file per hundred."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [png(w, h, d) if w > 0 else png(SIDE, SIDE, d)[:20] for w, h, d in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["name", "content"])

    shot = b.derived_images(spark, sf)
    folder = F.when(F.col("image.width") > 0, "good").otherwise("cut")
    name = F.concat(folder, F.lit("/"), (F.col("vec_id") % 7).cast("string"), F.format_string("/%06d.PNG", "vec_id"))
    coded = shot.select(name.alias("name"), "image.width", "image.height", "image.data").mapInArrow(encode, "name string, content binary")
    notes = shot.filter("vec_id % 100 = 0").select(
        F.format_string("notes/%06d.txt", "vec_id").alias("name"), F.lit("note").cast("binary").alias("content")
    )
    return listing.write_each(coded.unionByName(notes), root)


@query(
    "scan_image_folder",
    """SELECT printf('%s/%d/%06d.PNG', CASE WHEN label <> 9 THEN 'good' ELSE 'cut' END, vec_id % 7, vec_id) AS path,
        CASE WHEN label <> 9 THEN 8 END AS width, CASE WHEN label <> 9 THEN 8 END AS height,
        CASE WHEN label <> 9 THEN 1 END AS channels, CASE WHEN label <> 9 THEN 'L' END AS image_mode,
        'PNG' AS image_format, CASE WHEN label = 9 THEN 1 ELSE 0 END AS is_corrupt, TRUE AS same_size FROM embeddings""",
)
def scan_image_folder(spark, sf):
    """Image files written below nested folders, listed by the executors and read to their headers."""
    root = scratch_path(spark, "images")
    written = write_images(spark, sf, root)
    listed = listing.list_files(spark, root, "*.PNG")
    found = headers.image_headers(listed).join(listed.select("path", "size"), "path")
    sizes = written.select("path", F.col("size").alias("written"))
    return found.join(sizes, "path").select(
        F.substring("path", len(root) + 2, 1000).alias("path"),
        "width",
        "height",
        "channels",
        "image_mode",
        "image_format",
        "is_corrupt",
        (F.col("size") == F.col("written")).alias("same_size"),
    )


@query(
    "digest_files",
    """SELECT printf('%d/%d.txt', doc_id % 5, doc_id) AS name, octet_length(encode(text)) AS size, md5(text) AS md5, sha256(text) AS sha256
    FROM documents""",
)
def digest_files(spark, sf):
    """Every text written as a file; sizes from the listing, digests read in pieces of 4,096 bytes."""
    root = scratch_path(spark, "texts")
    name = F.concat((F.col("doc_id") % 5).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    listing.write_each(tables.parquet(spark, sf, "documents").select(name.alias("name"), F.col("text").alias("content")), root)
    listed = listing.list_files(spark, root)
    return (
        listing.digests(listed, chunk=4096)
        .join(listed.select("path", "size"), "path")
        .select(F.substring("path", len(root) + 2, 1000).alias("name"), "size", "md5", "sha256")
    )


@query(
    "latest_listed_file",
    """SELECT 'preferred' AS asked, CASE WHEN count_if(s_suppkey = 7) > 0 THEN '7_a.csv' END AS name FROM supplier
    UNION ALL SELECT 'newest', 'new_' || count(*) || '_a.csv' FROM supplier""",
)
def latest_listed_file(spark, sf):
    """The preferred file of a listing by a glob, and the newest where the preferred one is not there;
    later files that the glob leaves out do not count."""
    root = scratch_path(spark, "reports")
    rows = tables.parquet(spark, sf, "supplier")
    name = F.col("s_suppkey").cast("string")
    content = F.col("s_name").alias("content")
    listing.write_each(rows.select(F.concat(name, F.lit("_a.csv")).alias("name"), content), root)
    n = rows.agg(F.concat(F.lit("new_"), F.count("*").cast("string"), F.lit("_a.csv")).alias("name"), F.lit("x").alias("content"))
    listing.write_each(n, root)
    listing.write_each(rows.select(F.concat(name, F.lit("_b.csv")).alias("name"), content), root)
    listed = listing.list_files(spark, root, "*_a.csv")
    out = [
        files.latest_artifact(listed, preferred).select(F.lit(asked).alias("asked"), "name")
        for asked, preferred in (("preferred", "7_a.csv"), ("newest", "absent_a.csv"))
    ]
    return out[0].unionByName(out[1])
