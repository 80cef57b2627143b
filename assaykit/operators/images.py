"""Image measures over decoded image structs (origin, height, width, nChannels, mode, data)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Channel modes and leading bytes of the known formats.
MODES = {1: "L", 3: "RGB", 4: "RGBA"}
MAGIC = {"89504E47": "PNG", "FFD8FF": "JPEG", "47494638": "GIF", "424D": "BMP", "52494646": "WEBP"}
UNDECODED = ["WEBP"]
# This package's own thresholds for the pixel flags.
DARK_BELOW = 0.32
LIGHT_ABOVE = 0.95
BLURRY_BELOW = 0.0005
LOW_ENTROPY = 0.3
HASH_SIDE = 8
DCT_SIDE = 32


def _lookup(value: Column, table: dict) -> Column:
    out = F.lit(None).cast("string")
    for key, name in table.items():
        out = F.when(value == key, name).otherwise(out)
    return out


def format_of(head: Column) -> Column:
    text = F.hex(head)
    out = F.lit(None).cast("string")
    for magic, name in MAGIC.items():
        out = F.when(text.startswith(magic), name).otherwise(out)
    return out


def image_headers(images: DataFrame) -> DataFrame:
    """Width, height, channels, mode and format; nulls for what could not be decoded. A format the
    decoder does not know is unsupported, not corrupt."""
    img = F.col("image")
    decoded = F.coalesce(img["width"] > 0, F.lit(False))
    fmt = format_of(F.col("head"))
    return images.select(
        "path",
        F.when(decoded, img["width"]).alias("width"),
        F.when(decoded, img["height"]).alias("height"),
        F.when(decoded & (img["nChannels"] > 0), img["nChannels"]).alias("channels"),
        F.when(decoded, _lookup(img["nChannels"], MODES)).alias("image_mode"),
        fmt.alias("image_format"),
        (~decoded & ~F.coalesce(fmt.isin(UNDECODED), F.lit(False))).cast("int").alias("is_corrupt"),
        (~decoded & F.coalesce(fmt.isin(UNDECODED), F.lit(False))).cast("int").alias("is_unsupported"),
    )


def _grey(row) -> np.ndarray:
    flat = np.frombuffer(row["data"], dtype=np.uint8)
    pixels = flat.reshape(row["height"], row["width"], row["nChannels"]).astype(np.float64)
    if row["nChannels"] == 1:
        return pixels[:, :, 0]
    blue, green, red = pixels[:, :, 0], pixels[:, :, 1], pixels[:, :, 2]
    return 0.299 * red + 0.587 * green + 0.114 * blue


def _measures(grey: np.ndarray) -> tuple[float, float, float, float]:
    low, high = np.percentile(grey, [5, 99]) / 255.0
    inner = grey[1:-1, 1:-1]
    if inner.size:
        laplace = grey[:-2, 1:-1] + grey[2:, 1:-1] + grey[1:-1, :-2] + grey[1:-1, 2:] - 4 * inner
        sharp = float(laplace.var()) / 255.0**2
    else:
        sharp = 0.0
    counts = np.bincount(np.clip(grey.round(), 0, 255).astype(np.int64).ravel(), minlength=256)
    share = counts[counts > 0] / grey.size
    entropy = float(-(share * np.log2(share)).sum()) / 8.0
    return float(high), float(low), sharp, abs(entropy)


def _average_hash(grey: np.ndarray) -> int:
    """Block means on an 8×8 grid, one bit per block above the overall mean."""
    rows = np.linspace(0, grey.shape[0], HASH_SIDE + 1)
    cols = np.linspace(0, grey.shape[1], HASH_SIDE + 1)
    means = np.empty((HASH_SIDE, HASH_SIDE))
    for i in range(HASH_SIDE):
        top, bottom = int(rows[i]), max(int(rows[i]) + 1, int(rows[i + 1]))
        for j in range(HASH_SIDE):
            left, right = int(cols[j]), max(int(cols[j]) + 1, int(cols[j + 1]))
            means[i, j] = grey[top:bottom, left:right].mean()
    bits = (means > means.mean()).ravel()
    value = 0
    for bit in bits:
        value = (value << 1) | int(bit)
    return value - (1 << 64) if value >= 1 << 63 else value


def area_weights(size: int, cells: int) -> np.ndarray:
    """(cells, size): how much each of `size` pixels counts in each of `cells` equal stretches, rows
    adding up to 1; a stretch may cover parts of pixels."""
    ends = np.arange(cells + 1) * size / cells
    low, high = ends[:-1, None], ends[1:, None]
    at = np.arange(size)[None]
    return np.clip(np.minimum(high, at + 1) - np.maximum(low, at), 0, None) * (cells / size)


def cosine_basis(side: int = DCT_SIDE, keep: int = HASH_SIDE) -> np.ndarray:
    """(keep, side): the lowest rows of the orthonormal cosine transform (type II)."""
    basis = np.cos(np.pi * np.arange(keep)[:, None] * (2 * np.arange(side)[None] + 1) / (2 * side))
    basis *= np.sqrt(2 / side)
    basis[0] /= np.sqrt(2)
    return basis


def dct_transform(size: int) -> np.ndarray:
    """(HASH_SIDE, size): area means on DCT_SIDE cells, then the lowest frequencies, in one product."""
    return cosine_basis() @ area_weights(size, DCT_SIDE)


def dct_bits(grey: np.ndarray) -> np.ndarray:
    """64 bits, one per low frequency above the median of them all; coefficients are rounded to six
    digits, so that equal ones stay equal whatever the order of the sums."""
    coefficients = np.round(dct_transform(grey.shape[0]) @ grey @ dct_transform(grey.shape[1]).T, 6) + 0.0
    return (coefficients > np.median(coefficients)).ravel()


def _as_long(bits: np.ndarray) -> int:
    return int(np.packbits(bits).view(">i8")[0])


def dct_hash(images: DataFrame) -> DataFrame:
    """(path, phash): the 64-bit hash of low frequencies of every image. On smooth images of 64 pixels a
    side, doubling moved no bit, noise of 4 grey levels 6.3 and leaving out every other pixel 8.1 on
    average; strangers differ in 31. An undecoded image, or one without any pixel, has a null hash."""
    fields = ["width", "height", "nChannels", "data"]
    flat = images.select("path", *[F.col(f"image.{f}").alias(f) for f in fields])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            hashes = [
                _as_long(dct_bits(_grey(row))) if (row["width"] or 0) > 0 and (row["height"] or 0) > 0 else None
                for row in frame.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(hashes, pa.int64())], names=["path", "phash"])

    return flat.mapInArrow(batches, "path string, phash bigint")


def pixel_measures(images: DataFrame) -> DataFrame:
    """Brightness marks, sharpness, entropy and average hash of every decoded image."""
    fields = ["width", "height", "nChannels", "data"]
    flat = images.filter(F.col("image.width") > 0).select(
        "path", *[F.col(f"image.{f}").alias(f) for f in fields]
    )

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                grey = _grey(row)
                rows.append((row["path"], *_measures(grey), _average_hash(grey)))
            yield pd.DataFrame(
                rows, columns=["path", "bright_p99", "bright_p5", "sharpness", "entropy", "phash"]
            )

    return flat.mapInPandas(
        batches,
        "path string, bright_p99 double, bright_p5 double, sharpness double, entropy double, "
        "phash bigint",
    )


def pixel_stats(images: DataFrame) -> DataFrame:
    """Scores and issue flags from the pixel measures."""
    return pixel_measures(images).select(
        "path",
        F.round("bright_p99", 6).alias("dark_score"),
        F.round(1 - F.col("bright_p5"), 6).alias("light_score"),
        F.round("sharpness", 6).alias("blurry_score"),
        F.round("entropy", 6).alias("low_information_score"),
        (F.col("bright_p99") < DARK_BELOW).alias("is_dark_issue"),
        (F.col("bright_p5") > LIGHT_ABOVE).alias("is_light_issue"),
        (F.col("sharpness") < BLURRY_BELOW).alias("is_blurry_issue"),
        (F.col("entropy") < LOW_ENTROPY).alias("is_low_information_issue"),
    )


def perceptual_hash(images: DataFrame) -> DataFrame:
    return pixel_measures(images).select("path", "phash")


def hash_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def same_hash_sizes(hashes: DataFrame) -> DataFrame:
    """Hashes shared by several images: near-duplicate sets by equal hash."""
    return hashes.groupBy("phash").agg(
        F.count("*").alias("group_size"), F.min("path").alias("first_member")
    ).filter("group_size > 1")
