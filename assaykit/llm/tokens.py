"""Token ids of whole texts under a public tokenizer file, at the speed of a table lookup."""

from __future__ import annotations

import os
import re
import string

import numpy as np
import pyarrow as pa

from assaykit.llm.textbytes import LOWER, buffers, ragged, span_hashes, word_spans

CACHED_WORDS = 1_000_000
END_ID = 2
JOINED = 64

_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False
_IS_MARKS = np.zeros(256, bool)
_IS_MARKS[list(string.punctuation.encode())] = True
_IS_ALNUM = np.zeros(256, bool)
_IS_ALNUM[list((string.ascii_letters + string.digits).encode())] = True
# Stands alone between joined words; words that hold it are encoded one by one.
_MARK = "\x01"


_LOW = np.array([0, *((1 << 8 * n) - 1 for n in range(1, 9))], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """At each place the eight bytes from there on, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


class _Rows:
    """Arrays of differing lengths, one after another in a buffer that grows by doubling."""

    def __init__(self, dtype):
        self.flat = np.zeros(1 << 12, dtype)
        self.starts = np.zeros(1 << 8, np.int64)
        self.lengths = np.zeros(1 << 8, np.int64)
        self.count = self.used = 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        count, used = self.count + len(lengths), self.used + len(flat)
        self.flat = self._room(self.flat, used)
        self.starts, self.lengths = self._room(self.starts, count), self._room(self.lengths, count)
        self.flat[self.used : used] = flat
        self.starts[self.count : count] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.count : count] = lengths
        self.count, self.used = count, used

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries one after another, number in each row)."""
        lengths = self.lengths[rows]
        return self.flat[np.repeat(self.starts[rows], lengths) + ragged(lengths)], lengths


class _Table:
    """Words by a 64-bit hash in an open table that numpy probes for a whole batch at a time: their
    bytes, and their ids."""

    def __init__(self):
        self.keys, self.slots = np.zeros(1 << 12, np.uint64), np.full(1 << 12, -1, np.int32)
        self.hashes = np.zeros(0, np.uint64)
        self.words, self.ids = _Rows(np.uint8), _Rows(np.uint32)
        self.hit = np.zeros(0, bool)

    def __len__(self) -> int:
        return self.ids.count

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        mask = np.uint64(len(self.keys) - 1)
        out, todo, slot = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), hashes & mask
        while len(todo):
            place = self.slots[slot]
            same = self.keys[slot] == hashes[todo]
            out[todo] = np.where(same, place, -1)
            more = (place >= 0) & ~same
            todo, slot = todo[more], (slot[more] + np.uint64(1)) & mask
        return out

    def _enter(self, places: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        slot = self.hashes[places] & mask
        while len(places):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = places[free]
            won = self.slots[slot] == places
            self.keys[slot[won]] = self.hashes[places[won]]
            places, slot = places[~won], (slot[~won] + np.uint64(1)) & mask

    def add(self, hashes: np.ndarray, words, ids) -> None:
        """New words, each hash once; `words` and `ids` are (flat, lengths)."""
        old = len(self)
        self.words.add(*words)
        self.ids.add(*ids)
        self.hashes = np.concatenate([self.hashes[:old], hashes])
        self.hit = np.concatenate([self.hit, np.zeros(len(hashes), bool)])
        size = len(self.keys)
        while size < 3 * len(self):
            size *= 2
        if size > len(self.keys):
            self.keys, self.slots, old = np.zeros(size, np.uint64), np.full(size, -1, np.int32), 0
        self._enter(np.arange(old, len(self), dtype=np.int32))

    def frequent(self, most: int) -> _Table:
        """A table of the words that were met again, if those are at most `most`; else an empty one."""
        keep, out = np.flatnonzero(self.hit), _Table()
        if 0 < len(keep) <= most:
            out.add(self.hashes[keep], self.words.take(keep), self.ids.take(keep))
        return out


class Encoder:
    """Ids of texts under a tokenizers file whose pre-tokenizer never joins text across white space,
    always parts letters and digits from marks that follow them, and which lower-cases.

    A text is parted at ASCII white space, and a word into its stem, with ASCII letters lower-cased where it has no
    others, and the marks at its end. Every distinct part is encoded once by the library and kept in a bounded
    table (at `cached_words` only parts met again stay); the rest is numpy on the UTF-8 buffer. A part is
    found by its hash and then compared byte by byte. A text with a part whose hash another one has, or with the string of
    an added token in any case, goes to the library whole, which makes a token of it or not by the
    file's own settings.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        # a task has its core; the library's own threads would spend others' time waiting
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        # `whole` reads texts as the file says; the other one sees single words, where a string that is
        # an added token only after lower-casing must stay text
        self.whole, self.tokenizer = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        for tokenizer in (self.whole, self.tokenizer):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        added = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.IGNORECASE)
        lead = os.path.commonprefix([t.lower() for t in added])
        self.lead = b"" if not lead or lead[0].isalpha() else lead[0].encode()
        self.mark = self._ids([_MARK])[0]
        if len(self.mark) != 1:
            raise ValueError("the mark between joined words must be one token")
        self.cached_words = cached_words
        self.table = _Table()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _special(self, texts: pa.Array, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rows with the string of an added token, in any case."""
        rows = np.arange(len(off) - 1)
        if self.lead:
            places = np.flatnonzero(data == self.lead[0])
            rows = np.unique(np.searchsorted(off, places, "right") - 1)
        hits = [r for r, t in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist()) if t and self.added.search(t)]
        return np.array(hits, np.int64)

    def _library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each word), many words to a call."""
        odd = [i for i, w in enumerate(words) if _MARK in w]
        plain = [w for w in words if _MARK not in w] if odd else words
        groups = [f" {_MARK} ".join(plain[i : i + JOINED]) for i in range(0, len(plain), JOINED)]
        ids = []
        for one in self._ids(groups):
            ids += one
            ids += self.mark
        flat = np.array(ids, np.uint32)
        ends = np.flatnonzero(flat == self.mark[0])
        lengths = np.diff(ends, prepend=-1) - 1
        flat = flat[flat != self.mark[0]]
        if odd:
            rows = np.split(flat, np.cumsum(lengths)[:-1])
            for i, one in zip(odd, self._ids([words[i] for i in odd])):
                rows.insert(i, np.array(one, np.uint32))
            rows = rows[: len(words)]
            flat = np.concatenate(rows)
            lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return flat, lengths

    def _learn(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        new, at = np.unique(hashes, return_index=True)
        low, lengths = starts[at], (ends - starts)[at]
        data = body.tobytes()
        words = [data[a : a + n].decode() for a, n in zip(low.tolist(), lengths.tolist())]
        flat = body[np.repeat(low, lengths) + ragged(lengths)]
        self.table.add(new, (flat, lengths), self._library(words))

    @staticmethod
    def _parts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start, end, first) of stems and marks; `first` numbers the parts before each row."""
        starts, ends, first = word_spans(data, off, _IN_WORD)
        wide = np.concatenate([[0], np.cumsum(data >= 128)])
        plain = wide[ends] == wide[starts]
        body = LOWER[data]
        if not plain.all():
            low, n = starts[~plain], (ends - starts)[~plain]
            places = np.repeat(low, n) + ragged(n)
            body[places] = data[places]
        last = np.maximum.accumulate(np.where(_IS_MARKS[data], -1, np.arange(len(data)))) if len(data) else data
        stem = np.maximum(last[ends - 1] + 1, starts)
        unsplit = (stem > starts) & ~_IS_ALNUM[data[stem - 1]]
        stem[unsplit] = ends[unsplit]
        part_starts = np.stack([starts, stem], 1).ravel()
        part_ends = np.stack([stem, ends], 1).ravel()
        some = part_ends > part_starts
        before = np.concatenate([[0], np.cumsum(some)])
        return body, part_starts[some], part_ends[some], before[2 * first]

    def encode(self, texts: pa.Array | list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids as uint32, number of ids of each text); `end_id` follows every text if given."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        data, off = buffers(texts)
        odd = self._special(texts, data, off)
        body, starts, ends, first = self._parts(data, off)
        hashes = span_hashes(body, starts, ends)
        if len(self.table) > self.cached_words:
            self.table = self.table.frequent(self.cached_words // 2)
        at = self.table.find(hashes)
        unseen = at < 0
        self.table.hit[at[~unseen]] = True
        if unseen.any():
            self._learn(body, starts[unseen], ends[unseen], hashes[unseen])
            at[unseen] = self.table.find(hashes[unseen])
        odd = np.union1d(odd, self._clashes(body, starts, ends, first, at))
        flat, each = self.table.ids.take(at)
        before = np.concatenate([[0], np.cumsum(each)])
        lengths = np.diff(before[first])
        if len(odd):
            rows = np.split(flat, np.cumsum(lengths)[:-1])
            for i, text in zip(odd.tolist(), texts.take(pa.array(odd)).to_pylist()):
                rows[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            flat = np.concatenate(rows).astype(np.uint32)
            lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        if end_id is None:
            return flat, lengths
        out = np.full(len(flat) + len(lengths), end_id, np.uint32)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(lengths + 1) - 1] = False
        out[keep] = flat
        return out, lengths + 1

    def _clashes(self, body, starts, ends, first, at) -> np.ndarray:
        """Rows with a part whose bytes are not those of the part found by its hash: compared eight bytes
        at a time, long parts byte by byte."""
        lengths, words = ends - starts, self.table.words
        wrong, known = words.lengths[at] != lengths, words.starts[at]
        ours, theirs = _eights(body), _eights(words.flat[: words.used])
        left, a, b, which = np.where(wrong | (lengths > 64), 0, lengths), starts, known, np.arange(len(at))
        while len(which):
            mask = _LOW[np.minimum(left, 8)]
            wrong[which[(ours[a] ^ theirs[b]) & mask != 0]] = True
            more = left > 8
            left, a, b, which = left[more] - 8, a[more] + 8, b[more] + 8, which[more]
        long = np.flatnonzero(~wrong & (lengths > 64))
        n = lengths[long]
        step = ragged(n)
        differ = words.flat[np.repeat(known[long], n) + step] != body[np.repeat(starts[long], n) + step]
        wrong[np.repeat(long, n)[differ]] = True
        return np.unique(np.searchsorted(first, np.flatnonzero(wrong), "right") - 1)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, cached_words: int = CACHED_WORDS) -> Encoder:
    """One encoder per worker process, file and size of the word table, of which a million take some
    100 MB of the worker."""
    key = path, cached_words
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, cached_words)
    return _ENCODERS[key]


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
