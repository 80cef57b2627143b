"""Packing: every id once, no gaps, no padding; ids as the tokenizers library gives them."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from assaykit.llm import packing
from assaykit.llm.tokens import Encoder, word_bpe


def check(lengths, size):
    table, (rooms, _) = packing.pack_lengths(np.array(lengths, np.int64), size)
    used = {}
    for doc, start, length, seq, offset in table.tolist():
        assert 0 < length and offset + length <= rooms[seq]
        used.setdefault(seq, []).append((offset, length))
        used.setdefault(("doc", doc), []).append((start, length))
    for key, spans in used.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        if isinstance(key, tuple):
            assert at == lengths[key[1]]
        else:
            assert at == rooms[key] and (at == size or at & (at - 1) == 0)


def test_pack_lengths():
    rnd = random.Random(3)
    for _ in range(60):
        check([rnd.choice([1, 2, 7, 63, 64, 65, 128, 500]) for _ in range(rnd.randint(1, 80))], 64)
    check([1], 64)
    check([64 * 5], 64)


def test_costs_are_balanced():
    lengths = np.array([64] * 20 + [16] * 80 + [4] * 320)
    _, (rooms, costs) = packing.pack_lengths(lengths, 64, 0.0, 1.0)
    assert costs[rooms == 64].max() <= 64 * 64 and costs.sum() == (lengths**2).sum()


def test_rows_and_crc(spark):
    texts = ["Hello  World", None, "", "long " * 9000, "same", "same", "é <|endoftext|> 12"]
    rows = [(i if i != 5 else 4, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = packing.pack(df, group_tokens=5000).collect()
    library = Tokenizer.from_file(word_bpe())
    want = {}
    for doc, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.setdefault(doc, []).append(np.array(ids, "<u4"))
    for r in got:
        assert any(
            zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids)
            for ids in want[r.doc_id]
        )
    assert sum(r.length for r in got) == sum(len(i) for v in want.values() for i in v)
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length, r.capacity))
    for pieces in spans.values():
        assert sum(p[1] for p in pieces) == pieces[0][2] <= 4096
    assert packing.pack(df.limit(0)).collect() == []


def test_encoder_equals_library():
    rnd = random.Random(9)
    alphabet = [chr(i) for i in [*range(0, 700), *range(0x300, 0x340)]] + [
        chr(i) for i in (0x1680, 0x2000, 0x2028, 0x3000, 0x130, 0x3A3, 0x1100, 0x1161, 0xAC00, 0x1F600)
    ] + [" "] * 150 + ["'s", "'LL", "<|endoftext|>"] * 4
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 80))) for _ in range(1500)] + [None, "", "\x1c a"]
    small = Encoder(word_bpe(), cached_words=300)
    library = Tokenizer.from_file(word_bpe())
    for low in range(0, len(texts), 200):
        part = texts[low : low + 200]
        ids, lengths = small.encode(part)
        want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_special_token_strings_follow_the_file():
    """As the plain call has them: tokens where the file says so, text in another case or cut apart."""
    library, own = Tokenizer.from_file(word_bpe()), Encoder(word_bpe())
    texts = [
        "a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y <|endoftext|>", "<|ENDOFTEXT|> z", "<|EndOfText|>",
        "<|endoftext", "<| endoftext |>", "a < b | c", "plain", "",
    ]
    flat, lengths = own.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and flat.tolist() == sum(want, [])
    assert 49407 in want[0]


def test_equal_hashes_do_not_pass(monkeypatch):
    """With a hash of three values nearly all parts clash; their texts go to the library whole."""
    from assaykit.llm import tokens

    real = tokens.span_hashes
    monkeypatch.setattr(tokens, "span_hashes", lambda *a: real(*a) % np.uint64(3))
    library, own = Tokenizer.from_file(word_bpe()), Encoder(word_bpe())
    texts = ["one two three", "four, five", "x" * 100 + " " + "x" * 99 + "y", "x" * 99 + "z", "", "one"]
    flat, lengths = own.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and flat.tolist() == sum(want, [])
