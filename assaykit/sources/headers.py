"""Image headers from the first bytes of a file: no pixels are read."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame

from assaykit.sources.listing import read_each

# What the published file formats name the colour types.
PNG_MODES = {0: ("L", 1), 2: ("RGB", 3), 3: ("P", 1), 4: ("LA", 2), 6: ("RGBA", 4)}
JPEG_MODES = {1: ("L", 1), 3: ("RGB", 3), 4: ("CMYK", 4)}
BMP_MODES = {1: ("1", 1), 4: ("P", 1), 8: ("P", 1), 24: ("RGB", 3), 32: ("RGBA", 4)}
SCHEMA = "width int, height int, channels int, image_mode string, image_format string, is_corrupt int"


def _png(file: pa.NativeFile) -> tuple:
    length, kind, width, height, depth, colour = struct.unpack(">I4sIIBB", file.read(18))
    if kind != b"IHDR" or length != 13 or colour not in PNG_MODES:
        raise ValueError("no image header")
    mode, channels = PNG_MODES[colour]
    return width, height, channels, "1" if depth == 1 and colour == 0 else mode


def _jpeg(file: pa.NativeFile) -> tuple:
    """Segment by segment to the frame header, over thumbnails and other application data."""
    file.seek(2)
    while True:
        marker = file.read(2)
        if len(marker) < 2 or marker[0] != 0xFF:
            raise ValueError("no frame header")
        kind = marker[1]
        if kind == 0xFF:  # a fill byte
            file.seek(file.tell() - 1)
            continue
        if kind == 0x01 or 0xD0 <= kind <= 0xD8:
            continue
        length = struct.unpack(">H", file.read(2))[0]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            _, height, width, parts = struct.unpack(">BHHB", file.read(6))
            mode, channels = JPEG_MODES[parts]
            return width, height, channels, mode
        file.seek(file.tell() + length - 2)


def _gif(file: pa.NativeFile) -> tuple:
    file.seek(6)
    return (*struct.unpack("<HH", file.read(4)), 1, "P")


def _bmp(file: pa.NativeFile) -> tuple:
    file.seek(18)
    width, height, _, bits = struct.unpack("<iiHH", file.read(12))
    mode, channels = BMP_MODES[bits]
    return width, abs(height), channels, mode


def _webp(file: pa.NativeFile) -> tuple:
    file.seek(8)
    name, kind = file.read(4), file.read(4)
    if name != b"WEBP":
        raise ValueError("another container")
    file.seek(20)
    body = file.read(10)
    if kind == b"VP8 ":
        width, height = struct.unpack("<HH", body[6:10])
        return width & 0x3FFF, height & 0x3FFF, 3, "RGB"
    if kind == b"VP8L":
        packed = int.from_bytes(body[1:5], "little")
        alpha = packed >> 28 & 1
        return (packed & 0x3FFF) + 1, (packed >> 14 & 0x3FFF) + 1, 3 + alpha, "RGBA" if alpha else "RGB"
    if kind == b"VP8X":
        alpha = body[0] >> 4 & 1
        sides = (int.from_bytes(body[i : i + 3], "little") + 1 for i in (4, 7))
        return (*sides, 3 + alpha, "RGBA" if alpha else "RGB")
    raise ValueError("unknown kind")


FORMATS = [
    (b"\x89PNG\r\n\x1a\n", "PNG", _png),
    (b"\xff\xd8\xff", "JPEG", _jpeg),
    (b"GIF87a", "GIF", _gif),
    (b"GIF89a", "GIF", _gif),
    (b"BM", "BMP", _bmp),
    (b"RIFF", "WEBP", _webp),
]


def read_header(file: pa.NativeFile, size: int) -> tuple:
    """(width, height, channels, mode, format, is_corrupt) of one file. A file of no known format, one
    whose header is broken or cut off, or one with an empty side is corrupt; its size is null."""
    head = file.read(8)
    for magic, name, parse in FORMATS:
        if head.startswith(magic):
            file.seek(len(magic) if name == "PNG" else 0)
            try:
                width, height, channels, mode = parse(file)
            except (struct.error, ValueError, KeyError, IndexError, OSError):
                return None, None, None, None, name, 1
            good = 0 < width < 1 << 31 and 0 < height < 1 << 31
            return (width, height, channels, mode, name, 0) if good else (None, None, None, None, name, 1)
    return None, None, None, None, None, 1


def image_headers(files: DataFrame) -> DataFrame:
    """(path, width, height, channels, image_mode, image_format, is_corrupt) of listed files. A file that
    cannot be opened has nulls throughout."""
    return read_each(files, read_header, SCHEMA)
