"""Language mixtures of documents: expectation-maximisation over word likelihoods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.llm.columns import unused
from assaykit.llm.textbytes import LOWER, buffers, pieces, word_spans

GRAM_BITS = 18
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 2.0
UNKNOWN = "und"
MIN_SHARE = 0.3

#: a-z after lower-casing, and every byte of a character beyond ASCII.
IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = IS_LETTER[128:] = True

_MIX = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)]
_RESULT = pa.struct(
    [
        ("lang", pa.string()),
        ("score", pa.float64()),
        ("mixture", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
    ]
)
_RESULT_SQL = "struct<lang:string,score:double,mixture:array<struct<lang:string,share:double>>>"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def letter_grams(part: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, word, first): the bucket of the trigram that ends in each letter byte (shorter at a
    word's start), the place of each word's first letter, and the words before each row."""
    part = LOWER[part]
    starts, ends, first = word_spans(part, off, IS_LETTER)
    inside = IS_LETTER[part]
    now = np.where(inside, part, 0).astype(np.uint32)
    one, two = np.zeros_like(now), np.zeros_like(now)
    one[1:] = now[:-1]
    one[starts] = 0
    two[1:] = one[:-1]
    two[one == 0] = 0
    letters = np.flatnonzero(inside)
    mixed = now[letters] * _MIX[0] + one[letters] * _MIX[1] + two[letters] * _MIX[2]
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    grams = (mixed >> np.uint32(32 - GRAM_BITS)).astype(np.int64)
    sizes = ends - starts
    return grams, np.cumsum(sizes) - sizes, first


def train(docs: DataFrame, text_col: str, lang_col: str, usable: Column) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and log probabilities (gram bucket, language), from all rows that
    `usable` selects and that name a language. Tasks add up their own counts; one count for each
    language and bucket reaches the driver, however many rows there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            data, off = buffers(batch.column(0))
            for low, high in pieces(off):
                grams, words, first = letter_grams(data[off[low] : off[high]], off[low : high + 1] - off[low])
                ends = np.append(words, len(grams))[first]
                for row in range(low, high):
                    own = grams[ends[row - low] : ends[row - low + 1]]
                    if len(own):
                        total = totals.setdefault(langs[row], np.zeros(1 << GRAM_BITS, np.int64))
                        np.add.at(total, own, 1)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "gram": at, "n": total[at]})

    rows = (
        docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(text_col, lang_col)
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((1 << GRAM_BITS, len(names)))
    place = np.searchsorted(names, rows.column("lang").to_numpy().astype(str)) if names else []
    counts[rows.column("gram").to_numpy(), place] = rows.column("n").to_numpy()
    seen = max(1, int((counts.sum(1) > 0).sum()))
    totals = counts.sum(0) + SMOOTHING * (seen + 1)
    return names, np.log((counts + SMOOTHING) / totals).astype(np.float32)


def _mixtures(
    ratio: np.ndarray, top: np.ndarray, docs: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log likelihood) of each document over its allowed languages. `ratio` and `top` are
    the word likelihoods, relative to the word's best language, and that best's logarithm."""
    n = np.diff(np.append(first, len(ratio)))
    shares = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        part = ratio * shares[docs]
        part /= part.sum(1, keepdims=True)
        shares = np.add.reduceat(part, first, axis=0) / n[:, None]
    total = np.log((ratio * shares[docs]).sum(1)) + top
    return shares, np.add.reduceat(total, first)


def infer(
    grams: np.ndarray,
    words: np.ndarray,
    first: np.ndarray,
    logp: np.ndarray,
    penalty: float = PENALTY,
    rounds: int = ROUNDS,
) -> tuple[np.ndarray, np.ndarray]:
    """(documents with words, shares of each language in them).

    A word's likelihood under a language is the product of its grams'. EM gives the shares over all
    languages; nested sets of the languages with most share are compared by log likelihood less
    penalty * log(words) for every language beyond the first, and the best set's shares are the result.
    Where even all languages together gain less than one penalty over the best alone, that one stays.
    """
    n = np.diff(first)
    some = np.flatnonzero(n > 0)
    if not len(some):
        return some, np.zeros((0, logp.shape[1]))
    scores = np.add.reduceat(logp[grams], words, axis=0).astype(np.float64)
    top = scores.max(1)
    ratio = np.maximum(np.exp(scores - top[:, None]), 1e-30)
    starts, n = first[:-1][some], n[some]
    docs = np.repeat(np.arange(len(some)), n)
    langs = logp.shape[1]
    alone = np.add.reduceat(scores, starts, axis=0)
    best = alone.argmax(1)
    out = np.zeros((len(some), langs))
    out[np.arange(len(some)), best] = 1.0
    value = alone.max(1)
    if langs == 1:
        return some, out
    price = penalty * np.log(n + 1.0)
    shares, full = _mixtures(ratio, top, docs, starts, np.ones((len(some), langs)), rounds)
    order = np.argsort(-shares, axis=1, kind="stable")
    open_ = full - price > value
    for size in range(2, langs + 1):
        # a set's likelihood stays below that of all languages
        todo = np.flatnonzero(open_ & (full - (size - 1) * price > value))
        if not len(todo):
            break
        if size == langs:
            got, like = shares[todo], full[todo]
        else:
            allowed = np.zeros((len(todo), langs))
            np.put_along_axis(allowed, order[todo, :size], 1.0, axis=1)
            mine = np.isin(docs, todo)
            own = np.searchsorted(todo, docs[mine])
            at = np.cumsum(n[todo]) - n[todo]
            got, like = _mixtures(ratio[mine], top[mine], own, at, allowed, rounds)
        gain = like - (size - 1) * price[todo]
        better = gain > value[todo]
        out[todo[better]], value[todo[better]] = got[better], gain[better]
    return some, out


def language_of(text: Column, names: list[str], logp: np.ndarray, spark) -> Column:
    """struct<lang, score, mixture> of a whole text: the language with most share (ties: the first
    name), its share from 0 to 1, and all shares of the chosen set. `und` with 0 for a null text,
    one without a letter, or without a trained language."""
    model = spark.sparkContext.broadcast(logp)

    @F.arrow_udf(_RESULT_SQL)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, off = buffers(texts)
            rows: list[tuple] = [(UNKNOWN, 0.0, [])] * len(texts)
            for low, high in pieces(off) if names else ():
                grams, words, first = letter_grams(data[off[low] : off[high]], off[low : high + 1] - off[low])
                some, shares = infer(grams, words, first, model.value)
                for doc, share in zip(some.tolist(), shares):
                    best = int(share.argmax())
                    mixture = [{"lang": names[i], "share": float(share[i])} for i in np.flatnonzero(share > 0)]
                    rows[low + doc] = (names[best], min(1.0, float(share[best])), mixture)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _RESULT)] if rows else [pa.array([], f.type) for f in _RESULT],
                fields=list(_RESULT),
            )

    nothing = F.lit(None).cast(_RESULT_SQL)
    blank = F.struct(
        F.lit(UNKNOWN).alias("lang"),
        F.lit(0.0).alias("score"),
        F.array().cast("array<struct<lang:string,share:double>>").alias("mixture"),
    )
    return F.when(text.rlike(r"\p{L}"), F.coalesce(predict(text), nothing)).otherwise(blank)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Column:
    """Fits on the documents of `docs` that are not held out and name a language, and returns the
    column of `language_of` for its texts. Prediction reads the text alone."""
    names, logp = train(docs, text_col, lang_col, ~held_out(F.col(id_col)))
    return language_of(F.col(text_col), names, logp, docs.sparkSession)


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs`, with all their columns, whose language is known and has at least MIN_SHARE
    of the text."""
    name = unused(docs, "language")
    found = F.col(name)
    return (
        docs.withColumn(name, identify(docs, id_col, text_col, lang_col))
        .filter((found["lang"] != UNKNOWN) & (found["score"] >= MIN_SHARE))
        .drop(name)
    )
