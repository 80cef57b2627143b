"""Hamming groups against all pairs, the cosine hash, and files listed and read by the executors."""

import hashlib
import os
import random
import struct
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaykit.operators import hamming, images
from assaykit.sources import files, headers, listing

NULL = None


def brute(rows, radius):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, (_, x) in enumerate(rows):
        for j, (_, y) in enumerate(rows):
            if i != j and x is not None and y is not None and bin((x ^ y) & (1 << 64) - 1).count("1") <= radius:
                links[i] += 1
                parent[find(i)] = find(j)
    groups = {}
    for i, (key, x) in enumerate(rows):
        groups.setdefault(find(i), []).append((key is None, key, x))
    out = []
    for i, (key, x) in enumerate(rows):
        if x is None:
            out.append((key, x, key, None, 0))
            continue
        least = min(g[1] for g in groups[find(i)] if not g[0]) if any(not g[0] for g in groups[find(i)]) else None
        first = min(g[2] for g in groups[find(i)] if g[1] == least)
        out.append((key, x, least, first, links[i]))
    return sorted(out, key=repr)


def run(spark, rows, radius):
    df = spark.createDataFrame(rows, "path string, phash long")
    return sorted(map(tuple, hamming.hamming_groups(df, radius).collect()), key=repr)


def clouds(seed, groups=12, members=14):
    """Hashes around centres at all distances up to 12, some far below zero, copies, and lone ones."""
    rnd = random.Random(seed)
    out = []
    for _ in range(groups):
        centre = rnd.getrandbits(64)
        for _ in range(members):
            value = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 6)):
                value ^= 1 << bit
            out.append(value)
    out += [0, (1 << 64) - 1, 1 << 63, out[0], out[0]]
    return [(f"i{k:04d}", v - (1 << 64) if v >> 63 else v) for k, v in enumerate(out)]


@pytest.mark.parametrize("radius", [0, 1, 3, 7])
def test_hamming_groups_match_all_pairs(spark, radius):
    rows = clouds(radius)
    assert run(spark, rows, radius) == brute(rows, radius)


@pytest.mark.parametrize("radius", [3, 7])
def test_wide_bands_slices_and_reach(spark, monkeypatch, radius):
    """Few wide bands with variants, buckets cut into many slices: the same groups and counts."""
    monkeypatch.setattr(hamming, "BUCKET", 0)
    monkeypatch.setattr(hamming, "SLICE", 5)
    assert hamming.layout(radius, 100)[1] == hamming.MAX_REACH
    rows = clouds(20 + radius, groups=6)
    assert run(spark, rows, radius) == brute(rows, radius)


def test_hamming_edge_rows(spark):
    rows = [("a", NULL), (None, NULL), (None, 7), ("b", 7), ("b", 7), ("c", 6), (None, 1 << 40), ("", 0)]
    assert run(spark, rows, 1) == brute(rows, 1)
    assert run(spark, [], 3) == []
    df = spark.createDataFrame([("a", 5, 1, 2, 3)], "path string, phash long, h int, rows int, component int")
    assert [tuple(r) for r in hamming.hamming_groups(df, 2).collect()] == [("a", 5, "a", 5, 0)]
    with pytest.raises(ValueError):
        hamming.hamming_groups(df, 64)


def test_every_pair_within_the_radius_meets():
    """The bands' promise, for every radius and reach."""
    rnd = random.Random(1)
    for radius in range(1, 20):
        for n in (1, 10**6, 10**10, 10**14):
            bands, reach = hamming.layout(radius, n)
            assert sum(w for _, w in bands) == 64
            for _ in range(50):
                apart = sum(1 << b for b in rnd.sample(range(64), radius))
                assert any(bin(apart >> low & (1 << w) - 1).count("1") <= reach for low, w in bands)


def plain_dct_bits(grey):
    """Loops over the definition, on an image of 32 by 32."""
    n = 32
    c = np.zeros((8, 8))
    for u in range(8):
        for v in range(8):
            total = sum(
                grey[x][y] * np.cos(np.pi * u * (2 * x + 1) / (2 * n)) * np.cos(np.pi * v * (2 * y + 1) / (2 * n))
                for x in range(n)
                for y in range(n)
            )
            c[u, v] = total * 2 / n * (2**-0.5 if u == 0 else 1) * (2**-0.5 if v == 0 else 1)
    return (np.round(c, 6) > np.median(np.round(c, 6))).ravel()


def smooth(rng, size=64):
    small = rng.random((6, 6)) * 255
    w = images.area_weights(6, size)
    return w @ small @ w.T


def test_dct_bits_against_loops_and_changes():
    rng = np.random.default_rng(3)
    image = smooth(rng, 32)
    assert (images.dct_bits(image) == plain_dct_bits(image)).all()
    moved = {"noise": [], "half": [], "double": [], "other": []}
    for _ in range(40):
        image = smooth(rng)
        bits = images.dct_bits(image)
        moved["noise"].append((bits != images.dct_bits(image + rng.normal(0, 4, image.shape))).sum())
        moved["half"].append((bits != images.dct_bits(image[::2, ::2])).sum())
        moved["double"].append((bits != images.dct_bits(np.repeat(np.repeat(image, 2, 0), 2, 1))).sum())
        moved["other"].append((bits != images.dct_bits(smooth(rng))).sum())
    means = {k: float(np.mean(v)) for k, v in moved.items()}
    # measured: none when doubled, 6.3 of 64 bits under noise, 8.1 when every other pixel goes, 30.7 between strangers
    assert means["double"] == 0 and max(means["noise"], means["half"]) < means["other"] / 3, means


def test_area_weights():
    for size, cells in ((5, 3), (3, 5), (8, 32), (100, 32), (1, 32)):
        w = images.area_weights(size, cells)
        assert w.shape == (cells, size) and np.allclose(w.sum(1), 1) and np.allclose(w.sum(0) * size / cells, 1)


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(width, height, colour, depth=8):
    head = struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + b"no pixels here"


def jpeg(width, height, parts):
    thumb = b"\xff\xe1" + struct.pack(">H", 60_002) + b"\xff\xc0" * 30_000
    frame = b"\xff\xc2" + struct.pack(">HBHHB", 8 + 3 * parts, 8, height, width, parts) + b"\0" * 3 * parts
    return b"\xff\xd8" + thumb + b"\xff\xff" + b"\xdb" + struct.pack(">H", 4) + b"ab" + frame


SAMPLES = {
    "a.png": (png(7, 9, 0), (7, 9, 1, "L", "PNG", 0)),
    "b.png": (png(70_000, 1, 6), (70_000, 1, 4, "RGBA", "PNG", 0)),
    "one.png": (png(3, 3, 0, 1), (3, 3, 1, "1", "PNG", 0)),
    "c.jpg": (jpeg(640, 480, 3), (640, 480, 3, "RGB", "JPEG", 0)),
    "d.jpg": (jpeg(5, 6, 1), (5, 6, 1, "L", "JPEG", 0)),
    "e.gif": (b"GIF89a" + struct.pack("<HH", 20, 30) + b"\0" * 9, (20, 30, 1, "P", "GIF", 0)),
    "f.bmp": (b"BM" + b"\0" * 16 + struct.pack("<iiHH", 4, -5, 1, 24), (4, 5, 3, "RGB", "BMP", 0)),
    "g.webp": (b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 4 + b"\x10\0\0\0" + b"\x09\0\0" + b"\x13\0\0", (10, 20, 4, "RGBA", "WEBP", 0)),
    "h.webp": (b"RIFF\0\0\0\0WEBPVP8 " + b"\0" * 10 + struct.pack("<HH", 33, 44), (33, 44, 3, "RGB", "WEBP", 0)),
    "i.webp": (b"RIFF\0\0\0\0WEBPVP8L" + b"\0" * 4 + b"\x2f" + (11 | 21 << 14).to_bytes(4, "little") + b"\0" * 6, (12, 22, 3, "RGB", "WEBP", 0)),
    "cut.png": (png(7, 9, 0)[:20], (None, None, None, None, "PNG", 1)),
    "cut.jpg": (jpeg(7, 9, 3)[:60_020], (None, None, None, None, "JPEG", 1)),
    "zero.png": (png(0, 9, 2), (None, None, None, None, "PNG", 1)),
    "text.png": (b"hello", (None, None, None, None, None, 1)),
    "empty.png": (b"", (None, None, None, None, None, 1)),
}


def test_headers_of_all_formats(spark, tmp_path):
    for name, (content, _) in SAMPLES.items():
        (tmp_path / name).write_bytes(content)
    listed = listing.list_files(spark, str(tmp_path))
    found = {Path(r["path"]).name: tuple(r)[1:] for r in headers.image_headers(listed).collect()}
    assert found == {name: want for name, (_, want) in SAMPLES.items()}
    gone = listed.limit(1).select(F.concat("path", F.lit(".gone")).alias("path"))
    assert [tuple(r)[1:] for r in headers.image_headers(gone).collect()] == [(None,) * 6]


def test_listing_digests_and_newest(spark, tmp_path):
    made = {}
    for i in range(60):
        path = tmp_path / f"d{i % 4}/e{i % 3}" / f"f{i}.{'PNG' if i % 5 else 'txt'}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(os.urandom(i * 997))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        made[str(path)] = path.read_bytes()
    (tmp_path / "d1/_hidden").mkdir()
    (tmp_path / "d1/_hidden/x.PNG").write_bytes(b"x")
    (tmp_path / ".dot.PNG").write_bytes(b"x")
    (tmp_path / "empty/deep/er").mkdir(parents=True)
    listed = listing.list_files(spark, str(tmp_path))
    assert {r["path"]: r["size"] for r in listed.collect()} == {p: len(c) for p, c in made.items()}
    digests = {r["path"]: (r["md5"], r["sha256"]) for r in listing.digests(listed, chunk=1000).collect()}
    assert digests == {p: (hashlib.md5(c).hexdigest(), hashlib.sha256(c).hexdigest()) for p, c in made.items()}
    shots = listing.list_files(spark, str(tmp_path), "f[1-4]?.P*")
    names = sorted(r["name"] for r in shots.collect())
    assert names == sorted(f"f{i}.PNG" for i in range(10, 50) if i % 5)
    newest = files.latest_artifact(shots, "f7.PNG").collect()
    assert [r["name"] for r in newest] == ["f49.PNG"]
    assert [r["name"] for r in files.latest_artifact(listed, "f7.PNG").collect()] == ["f7.PNG"]
    assert files.count_images(listed).first()["n_images"] == 48
    assert listing.list_files(spark, f"file://{tmp_path}/empty").collect() == []
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, str(tmp_path / "nowhere"))


def test_written_files_read_back(spark, tmp_path):
    rows = [("a/b.bin", b"\0\1"), ("c.bin", None), ("a/d.bin", b"x" * 5000)]
    written = listing.write_each(spark.createDataFrame(rows, "name string, content binary"), str(tmp_path))
    assert {r["path"]: r["size"] for r in written.collect()} == {f"{tmp_path}/{n}": len(c or b"") for n, c in rows}
    assert all((tmp_path / n).read_bytes() == (c or b"") for n, c in rows)


def test_dct_hash_of_frames(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(6):
        side = 16 + i
        rows.append((f"i{i}", (side, side, 1, rng.integers(0, 256, side * side, dtype=np.uint8).tobytes())))
    rows += [("broken", (-1, -1, -1, b"")), ("none", None)]
    df = spark.createDataFrame(rows, "path string, image struct<width int, height int, nChannels int, data binary>")
    found = {r["path"]: r["phash"] for r in images.dct_hash(df).collect()}
    assert found["broken"] is None and found["none"] is None and len(found) == 8
    for path, (w, h, _, data) in rows[:6]:
        bits = images.dct_bits(np.frombuffer(data, np.uint8).reshape(h, w).astype(float))
        want = int("".join("1" if b else "0" for b in bits), 2)
        assert found[path] == (want - (1 << 64) if want >> 63 else want)


def test_a_large_folder_is_listed_in_pieces(tmp_path, monkeypatch):
    import os

    import pyarrow.fs as fs

    monkeypatch.setattr(listing, "PIECE", 7)
    for i in range(30):
        (tmp_path / f"f{i}").write_bytes(b"x" * i)
    (tmp_path / "inner").mkdir()
    (tmp_path / "_hidden").write_text("x")
    os.symlink(tmp_path / "f3", tmp_path / "link")
    os.symlink(tmp_path / "nowhere", tmp_path / "broken")
    pieces = list(listing._entries(str(tmp_path)))
    assert max(map(len, pieces)) <= 7 and len(pieces) > 1
    whole = fs.LocalFileSystem().get_file_info(fs.FileSelector(str(tmp_path), recursive=False))
    want = [
        (str(tmp_path), i.path, i.base_name, i.size, i.mtime, i.type == fs.FileType.Directory)
        for i in whole
        if i.base_name != "_hidden"
    ]
    assert sorted(map(str, sum(pieces, []))) == sorted(map(str, want))
