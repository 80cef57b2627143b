"""Packing of tokenised documents into training sequences of balanced attention cost."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.llm.textbytes import buffers, pieces
from assaykit.llm.tokens import CACHED_WORDS, END_ID, encoder, word_bpe

SEQUENCE = 4096
GROUP_TOKENS = 1 << 21
LINEAR = 1.0
QUADRATIC = 1.0 / 4096

SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "capacity long, cost double"
)


def _rooms(total: int, size: int) -> np.ndarray:
    """Capacities that hold exactly `total` tokens: whole sequences, and powers of two, which need
    no padding, for the rest."""
    rest = total % size
    tail = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return np.array([size] * (total // size) + tail, np.int64)


def pack_lengths(
    lengths: np.ndarray, size: int = SEQUENCE, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (document, start, length, sequence, offset) that fill sequences without a gap, and the
    capacities of the sequences.

    A document longer than a sequence first fills whole sequences. What is left goes in descending
    order of estimated cost, linear * n + quadratic * n^2, to the sequence of lowest cost so far that
    has room for it (ties: the earlier sequence); when none has, the sequence with most room takes
    as much as it holds and the rest of the document goes on. Capacities add up to the tokens, so
    everything finds its place.
    """
    rooms = _rooms(int(lengths.sum()), size)
    left, costs, out = rooms.copy(), np.zeros(len(rooms)), []
    whole = 0
    for doc in np.flatnonzero(lengths > size):
        for start in range(0, int(lengths[doc]) - size + 1, size):
            out.append((doc, start, size, whole, 0))
            left[whole], costs[whole] = 0, linear * size + quadratic * size * size
            whole += 1
    rest = np.where(lengths > size, lengths % size, lengths)
    for doc in np.argsort(-rest, kind="stable"):
        todo = int(rest[doc])
        while todo:
            fits = np.flatnonzero(left >= todo)
            at = fits[np.argmin(costs[fits])] if len(fits) else int(np.argmax(left))
            take = min(todo, int(left[at]))
            start = int(lengths[doc]) - todo
            out.append((doc, start, take, at, int(rooms[at] - left[at])))
            left[at] -= take
            costs[at] += linear * take + quadratic * take * take
            todo -= take
    table = np.array(out, np.int64).reshape(-1, 5)
    return table, np.stack([rooms.astype(float), costs])


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    size: int = SEQUENCE,
    group_tokens: int = GROUP_TOKENS,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    sequence's capacity and estimated cost.

    Every document is tokenised whole, followed by `end_id`; a null text is empty and has that id
    alone. Tasks gather documents until a group has `group_tokens` tokens, pack it, and go on, so a
    task holds one group (or one longer document) and nothing is shuffled. Sequences of a group are
    full, or powers of two at its end, and need no padding. Sequence ids name task, group and place
    and are unique over the job. Repeated rows are packed as often as they occur; other columns are
    not read.
    """
    file = tokenizer or word_bpe()
    key = docs.schema[id_col]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file, cached_words).encode
        task, group = TaskContext.get().partitionId(), 0
        keys, flats, counts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal group
            lengths, ids = np.concatenate(counts), np.concatenate(flats)
            before = np.cumsum(lengths) - lengths
            table, (rooms, costs) = pack_lengths(lengths, size, linear, quadratic)
            doc, start, length, seq, offset = table.T
            data, first = memoryview(ids.astype("<u4")).cast("B"), 4 * (before[doc] + start)
            crc = [zlib.crc32(data[a : a + 4 * n]) for a, n in zip(first.tolist(), length.tolist())]
            columns = [
                pa.concat_arrays(keys).take(pa.array(doc)),
                *map(pa.array, (start, length, np.array(crc, np.int64), lengths[doc])),
                pa.array((task << 40) + (group << 24) + seq),
                *map(pa.array, (offset, rooms[seq].astype(np.int64), costs[seq])),
            ]
            group += 1
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            _, off = buffers(batch.column(1))
            for low, high in pieces(off):
                ids, each = encode(batch.column(1)[low:high], end_id)
                keys.append(batch.column(0)[low:high])
                flats.append(ids)
                counts.append(each)
                held += len(ids)
                if held >= group_tokens:
                    yield flush()
                    keys, flats, counts, held = [], [], [], 0
        if held:
            yield flush()

    names = [id_col, *(c.split()[0] for c in SCHEMA.split(", "))]
    schema = f"`{id_col}` {key.dataType.simpleString()}, {SCHEMA}"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(packed, schema)
