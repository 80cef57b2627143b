"""The divergence audit against plain loops over whole documents."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from assaykit.llm import divergence

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, least=divergence.LEAST_DOCS):
    docs = [
        (lang or "", source or "", re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER)))
        for text, lang, source in rows
    ]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= least]
        counts = {s: Counter() for at, s, _ in docs if at == lang}
        for at, source, words in docs:
            if at == lang:
                counts[source].update(w for w in words if held[w] >= least)
        every = sum(counts.values(), Counter())

        def share(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        q, f = share(every), lambda x, y: (x - y) ** 2 // (x + y)
        for source, own in counts.items():
            p = share(own)
            others = {s: share(c) for s, c in counts.items() if s != source}
            parts = {
                "pair": [(sum(f(p[t], r[t]) for t in kept), s) for s, r in others.items()],
                "term": [(f(p[t], q[t]), t) for t in kept if own[t] and p[t] > q[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                found = found if part == "pair" else found[: divergence.TERM_RANKS]
                out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def run(spark, rows, parts=3, **more):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(parts)
    found = divergence.source_divergence(df, **more)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def corpus(seed, docs=400, sources=7):
    rnd = random.Random(seed)
    words = [rnd.choice(["Wort", "mot", "été", "ÉTÉ", "x", "Zebra", "日本"]) + "abcdefghij"[i % 10] for i in range(60)]
    rows = []
    for _ in range(docs):
        lang, source = rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["hot"] * 4 + [f"s{i}" for i in range(sources)])
        own = [rnd.choice(words[: 20 + 5 * len(source)]) for _ in range(rnd.randint(0, 40))]
        rows.append((rnd.choice([" ", "-", "1, ", "\x00"]).join(own), lang, source))
    return rows + [(None, "en", "s0"), ("", "xx", None), ("lone", "xx", "a"), (None, None, None)]


def test_matches_plain_loops(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("held", [5, 400_000])
def test_shards_blocks_and_merges(spark, monkeypatch, held):
    """Shards of few terms, blocks of two sources, tasks that hand on what they hold: equal results."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", 5)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "HELD", held)
    rows = corpus(2, docs=250)
    assert run(spark, rows, least_docs=3) == brute(rows, least=3)


def test_ties_repeated_rows_and_long_texts(spark):
    rows = [("b a c", "en", "one")] * 12 + [("d e f", "en", "two")] * 12 + [("g " * 300_000 + "B", "en", "two")]
    assert run(spark, rows) == brute(rows)


def test_without_kept_terms_and_empty_table(spark):
    rows = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", "z")]
    found = run(spark, rows)
    assert found == brute(rows) and {r[4] for r in found} == {0} and len(found) == 6
    assert run(spark, []) == []


def test_other_columns(spark):
    rows = [("a b a", "en", s, 1, "t", 5) for s in ("x", "y") for _ in range(10)]
    df = spark.createDataFrame(rows, "text string, lang string, source string, n int, term string, docs int")
    plain = [(r[0], r[1], r[2]) for r in rows]
    assert sorted(map(tuple, divergence.source_divergence(df).collect())) == brute(plain)


def test_shares_by_long_division():
    rng = np.random.default_rng(3)
    for total in (1, 7, 10**6, 9 * 10**15):
        counts = rng.integers(0, max(1, total - 2), 50)
        assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in counts]


def test_counts_of_one_slice():
    rows = pa.RecordBatch.from_pydict(
        {
            "lang": pa.array(["en", "en", ""], pa.large_string()),
            "source": pa.array(["a", "a", "b"], pa.large_string()),
            "text": pa.array(["X x é", "x", ""], pa.large_string()),
        }
    )
    found = {tuple(r.values()) for r in divergence._count(rows).to_pylist()}
    assert found == {("en", "a", "x", 3, 2), ("en", "a", "é", 1, 1), ("en", "a", None, 0, 2), ("", "b", None, 0, 1)}
