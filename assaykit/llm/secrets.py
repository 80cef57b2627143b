"""Secret scans: known credential forms, and random strings that a tokenizer spells inefficiently."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16}
RANDOM_CHARS = 20
CHARS_PER_TOKEN = 2.1
MASK = "[secret]"
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A run that fails its length hides no longer one, so the length can stand in the pattern.
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{LEAST['hex']},}}")
_RUN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{RANDOM_CHARS},}}")
_EDGE = "+/_=.-"
_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{_UUID})(?![A-Za-z0-9])|[A-Za-z0-9]+")
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_PLAIN = re.compile(r"[a-z]+[0-9]{0,4}|[0-9]+")
# Words in one case or capitalised ones, with a short number: parts of identifiers, paths and hosts.
_NAME = re.compile(r"[A-Za-z]*[0-9]{0,4}|[0-9]+")

Span = tuple[str, int, int]


def _is_digest(part: str) -> bool:
    """A UUID, or a digest of a usual length in one case."""
    return "-" in part or (len(part) in DIGEST_CHARS and _DIGEST.fullmatch(part) is not None)


def _unknown(run: str) -> tuple[int, int] | None:
    """The stretch of a run that is not accounted for: nothing where every part is a digest, a UUID, a
    word or a number, else the run without digests, lower-case words and numbers at its ends; all of it where
    that leaves too little to judge."""
    parts = [(m.start(), m.end(), m.group()) for m in _PART.finditer(run)]
    if all(_is_digest(p) or (_NAME.fullmatch(p) and _wordlike(p)) for _, _, p in parts):
        return None
    odd = [(start, end) for start, end, p in parts if not (_is_digest(p) or _PLAIN.fullmatch(p))]
    if odd and odd[-1][1] - odd[0][0] >= RANDOM_CHARS:
        return odd[0][0], odd[-1][1]
    return 0, len(run)


def _wordlike(part: str) -> bool:
    """Camel case changes case at most once in three letters."""
    letters = part.rstrip("0123456789")
    turns = sum(a.islower() != b.islower() for a, b in zip(letters, letters[1:]))
    return turns <= len(letters) / 3


def _covered(span: Span, taken: list[tuple[int, int]]) -> bool:
    """Whether the stretches, in order of their starts, leave nothing of the span."""
    _, at, stop = span
    for start, end in taken:
        if start > at or at >= stop:
            break
        at = max(at, end)
    return at >= stop


class Scanner:
    """Finds spans in a text; holds the vocabulary, so there is one per worker."""

    def __init__(self, vocabulary: str, pattern: str, ratio: float):
        import base64

        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.ratio = ratio

    def base(self, text: str) -> list[Span]:
        """Spans of the known forms, leftmost and non-overlapping within each kind."""
        found = [
            ("assign", m.start(), m.end())
            for m in _ASSIGN.finditer(text)
            if m.end(1) - m.start(1) >= LEAST["assign"]
        ]
        if "AKIA" in text:
            found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
        found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
        return found

    def random(self, text: str) -> list[Span]:
        """Long runs with letters and digits whose characters per token fall below the ratio."""
        found = []
        for m in _RUN.finditer(text):
            run = m.group()
            start = m.start() + len(run) - len(run.lstrip(_EDGE))
            run = run.strip(_EDGE)
            if len(run) < RANDOM_CHARS or not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
                continue
            stretch = _unknown(run)
            if stretch is None:
                continue
            low, high = stretch
            if high - low < self.ratio * len(self.encode(run[low:high])):
                found.append(("random", start + low, start + high))
        return found

    def scan(self, text: str | None) -> list[Span]:
        """All spans by start, then kind; a random string that known forms cover whole is not named again."""
        if not text:
            return []
        spans = self.base(text)
        taken = sorted((s, e) for _, s, e in spans)
        spans += [r for r in self.random(text) if not _covered(r, taken)]
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def mask(text: str, spans: list[Span], word: str = MASK) -> str:
    """The text with every covered stretch replaced once."""
    out, at = [], 0
    for _, start, stop in spans:
        if start >= at:
            out += [text[at:start], word]
        at = max(at, stop)
    return "".join([*out, text[at:]]) if spans else text


_SCANNERS: dict[tuple, Scanner] = {}


def _scanner(*args) -> Scanner:
    if args not in _SCANNERS:
        _SCANNERS[args] = Scanner(*args)
    return _SCANNERS[args]


def _vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def find_secrets(
    text: Column, vocabulary: str | None = None, pattern: str | None = None, ratio: float = CHARS_PER_TOKEN
) -> Column:
    """array<struct<kind, start, stop>> of the secrets in a whole text, in code points, stop exclusive,
    by start and then kind. A null or empty text has none. One Arrow UDF on the text column alone;
    the row's other columns stay in the JVM."""
    default = _vocabulary()
    args = (vocabulary or default[0], pattern or default[1], ratio)

    @F.arrow_udf("array<struct<kind:string,start:int,stop:int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = _scanner(*args).scan
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for texts in batches:
            rows = [
                [{"kind": k, "start": s, "stop": e} for k, s, e in scan(t.as_py())] for t in texts
            ]
            yield pa.array(rows, kind)

    return found(text)


def redact_secrets(
    text: Column, vocabulary: str | None = None, pattern: str | None = None, ratio: float = CHARS_PER_TOKEN
) -> Column:
    """The text with every secret replaced by a mask; a null stays null, a clean text as it is."""
    default = _vocabulary()
    args = (vocabulary or default[0], pattern or default[1], ratio)

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = _scanner(*args).scan
        for texts in batches:
            rows = (t.as_py() for t in texts)
            yield pa.array([t if t is None else mask(t, scan(t)) for t in rows], pa.string())

    return clean(text)


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows of `docs` with secrets masked in the text and, where there is such a column, the number
    of characters counted anew; a null text keeps its number."""
    clean = docs.withColumn(text_col, redact_secrets(F.col(text_col)))
    if chars_col not in docs.columns:
        return clean
    counted = F.coalesce(F.length(text_col), F.col(chars_col)).cast(docs.schema[chars_col].dataType)
    return clean.withColumn(chars_col, counted)


def report(spans: Column) -> dict[str, Column]:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""

    def named(array: Column) -> Column:
        return F.array_join(
            F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": count(kind) for kind in KINDS[:3]}
    base = F.filter(spans, lambda s: s["kind"] != "random")
    return counts | {"base_sha256": F.sha2(named(base), 256), "spans": named(spans)}
