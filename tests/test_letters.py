"""Letter shares against counting by hand, and how often the texts are read for them."""

import random

import pytest
from pyspark.sql import functions as F

from assaykit.functions import letters
from assaykit.plans import bindings as b
from assaykit.plans import catalog

TEXTS = ["", "a", "Äpfel ÄÖ ß ẞ é", "ñandú Çà €uro 日本 Ā", "İK ü", "e" * 50, "x\U0001f600ä", "\xc2\xa0ä\xc3"]


def texts():
    rnd = random.Random(3)
    return TEXTS + ["".join(rnd.choice(b.LETTERS + " ÉZ0€") for _ in range(rnd.randrange(400))) for _ in range(60)]


def test_shares_by_hand(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts())), "i long, text string").repartition(3)
    # lower-casing is Spark's own
    low = {r["i"]: (r["low"], r["n"]) for r in df.select("i", F.lower("text").alias("low"), F.length("text").alias("n")).collect()}
    got = {r["i"]: r["s"] for r in df.select("i", letters.shares(F.col("text"), b.LETTERS).alias("s")).collect()}
    assert got == {i: [t.count(c) / max(n, 1) for c in b.LETTERS] for i, (t, n) in low.items()}


def test_pairs_across_pieces(monkeypatch):
    import numpy as np

    monkeypatch.setattr(letters, "PIECE", 3)
    for text in texts():
        data = np.frombuffer(text.encode(), np.uint8)
        got = letters._counts(data, np.array([97, 101]), np.array([0xC39F, 0xC3A4, 0xC3BC]))
        assert got.tolist() == [text.count(c) for c in "aeßäü"], text


def test_letters_are_checked():
    for bad in ("a€", "aba"):
        with pytest.raises(ValueError):
            letters.shares(F.lit("x"), bad)


def written(spark, folder, n=120):
    words = {"de": "der große Fluß läuft über", "en": "the way that which with", "es": "el niño pequeño aquí", "fr": "où été français même"}
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        lang = rnd.choice(["de", "en", "en", "es", "fr"])
        said = words[lang].split()
        rows.append((i, " ".join(rnd.choice(said) for _ in range(20)), lang))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["train_candidates", "batch_score", "evaluate_candidates"])
def test_texts_are_read_once(spark, tmp_path, monkeypatch, name):
    """The letters are counted once for training, scoring and judging alike."""
    sf, reads = written(spark, tmp_path), []
    plain = b.letter_shares
    monkeypatch.setattr(b, "letter_shares", lambda *at: reads.append(at) or plain(*at))
    out = catalog.queries()[name](spark, sf)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(reads) == 1 and "translate(" not in plan and "lower(" not in plan
    assert all(r["above_majority"] for r in out.collect())
