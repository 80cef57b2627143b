"""Winnowing against every window compared."""

import hashlib
import random
import re

import numpy as np
import pytest

from assaykit.llm import contamination as c

LOWER = str.maketrans({chr(x): chr(x + 32) for x in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(0, len(w) - 9) or bool(w)):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    left = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, row int, found string")
    right = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in c.contamination(left, right).drop("text_hash").collect()), key=repr)


@pytest.mark.parametrize("vocabulary", [3, 400])
def test_random_texts(spark, vocabulary):
    rnd = random.Random(vocabulary)
    text = lambda n: " ".join(rnd.choice("Aab, éü") + str(rnd.randrange(vocabulary)) for _ in range(n))
    items = [(i, text(rnd.randint(10, 40))) for i in range(12)] + [(50 + n, text(n)) for n in (0, 1, 4, 5, 9)]
    docs = []
    for i in range(60):
        body = text(rnd.randint(0, 60)).split(" ")
        if rnd.random() < 0.5:
            other = rnd.choice(items)[1].upper().split(" ")
            cut = rnd.randint(0, 5)
            body[len(body) // 2 : len(body) // 2] = other[cut : len(other) - rnd.randint(0, 5)]
        docs.append((i, rnd.choice([" ", "\n", " -- "]).join(body)))
    assert run(spark, docs, items) == brute(docs, items)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    items = [(1, " ".join(f"w{i}" for i in range(20_000, 20_012))), (2, None), (3, "..."), (None, "solo item"), (4, "rare"), (4, "rare")]
    docs = [
        (1, None), (2, ""), (3, "?!"), (4, long), (None, "a solo  ITEM b"), (None, None), (5, "Rare"), (5, "Rare"), (6, "rare rare solo item"),
    ]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "a b c")], [(1, "a")]
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == brute(docs, [])
    none = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert c.drop_contaminated(none, spark.createDataFrame([], "item_id long, text string")).count() == 1


def test_drop_keeps_rows_and_columns(spark):
    rows = [(1, "clean words", "x"), (None, "bad item here", "y"), (None, "clean", "z"), (1, "clean words", "x"), (2, "the BAD, item", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _bad_id string")
    items = spark.createDataFrame([(1, "bad item")], "item_id long, text string")
    got = c.drop_contaminated(df, items)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([rows[0], rows[2], rows[3]], key=repr)


def test_equal_windows_share_a_fingerprint():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 5, 400).astype(np.uint64)
    starts, prints = c.window_prints(h, np.zeros(400, int), 10, 5)
    seen = {}
    for s, p in zip(starts, prints):
        assert seen.setdefault(tuple(h[s : s + 10]), p) == p
