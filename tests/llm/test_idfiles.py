"""Id files: the library's ids come back, by key, and the hash is minimal and perfect."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from assaykit.llm import idfiles
from assaykit.llm.tokens import word_bpe
from assaykit.session import scratch_path


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1000, 4097])
def test_minimal_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
    pilots, slots = idfiles.build_hash(keys, seed=n)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert np.array_equal(idfiles._slots(idfiles._hashed(keys, n), pilots, len(keys)), slots)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(idfiles, "BUCKET_KEYS", 8)
    texts = ["Hello World", None, "", "many words " * 3000, "é", "<|endoftext|>"]
    rows = [(7 * i - 100, texts[i % 6], "x") for i in range(60)] + [(5, "twice", "y")] * 3 + [(5, "other", "y"), (None, "no id", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    path = scratch_path(spark, "ids")
    idfiles.write_shards(df, path, shard_tokens=500)
    idfiles.build_index(spark, path)
    library = Tokenizer.from_file(word_bpe())
    ids = [(d, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for d, t, _ in rows]
    got = [tuple(r) for r in idfiles.read_documents(spark, path, df).collect()]
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(((d, len(i), zlib.crc32(i.tobytes())) for d, i in ids), key=repr)
    at = 0
    for doc, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    asked = spark.createDataFrame([(-100,), (-79,), (999,), (-79,)], "doc_id long")
    found = {r.doc_id: np.frombuffer(r.ids, f"<u{r.width}").tolist() for r in idfiles.fetch(spark, path, asked).collect()}
    assert found == {d: i.tolist() for d, i in ids if d in (-100, -79)}


def test_empty(spark):
    path = scratch_path(spark, "ids")
    none = spark.createDataFrame([], "doc_id long, text string")
    idfiles.write_shards(none, path)
    idfiles.build_index(spark, path)
    assert idfiles.read_documents(spark, path, none).collect() == []
