"""URL judgement: host and path rules first, a weighted vocabulary for the rest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRICT = ("adult", "casino", "porn", "xxx", "spam")
SOFT = ("cheap", "pills", "free", "bets", "win", "ads", "track", "farm", "deals", "loans")
SOFT_LIMIT = 2
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_JUDGED = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("n_strict", T.LongType()),
        T.StructField("n_soft", T.LongType()),
    ]
)
_ARROW = pa.struct(
    [("rule", pa.string()), ("verdict", pa.string()), ("n_strict", pa.int64()), ("n_soft", pa.int64())]
)


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without a `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@lru_cache(maxsize=4)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    terms = ahocorasick.Automaton()
    for weight, words in (("soft", soft), ("strict", strict)):
        for word in words:
            terms.add_word(word, (weight, word))
    terms.make_automaton()
    return terms


def _bounded(text: str, start: int, stop: int) -> bool:
    """No ASCII letter or digit and no character beyond ASCII touches text[start:stop]."""
    for at in (start - 1, stop):
        if 0 <= at < len(text) and (text[at] > "\x7f" or text[at].isalnum()):
            return False
    return True


def vocabulary_hits(url: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """(strict hits, distinct soft terms) with a boundary on both sides, A-Z lower-cased."""
    if not strict and not soft:
        return 0, 0
    text = url.translate(_LOWER)
    n_strict, softs = 0, set()
    for last, (weight, word) in _automaton(strict, soft).iter(text):
        if _bounded(text, last + 1 - len(word), last + 1):
            if weight == "strict":
                n_strict += 1
            else:
                softs.add(word)
    return n_strict, len(softs)


_LOWER = {ord(c): c.lower() for c in UPPER}


def _best_rule(host_: str, path_: str, by_host: dict[str, list[tuple[str, str, str]]]):
    """The longest (rule, verdict) whose host is this one or a parent and whose path starts it."""
    best, tail = ("", None), host_
    while tail:
        for start, rule, verdict in by_host.get(tail, ()):
            if len(rule) > len(best[0]) and path_.startswith(start):
                best = (rule, verdict)
        dot = tail.find(".")
        tail = tail[dot + 1 :] if dot >= 0 else ""
    return best if best[0] else (None, None)


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """(id, host, path, rule, verdict, n_strict, n_soft), one row per row of `pages`.

    A rule `host/path` fits its host and all subdomains when the path of the url starts with its
    own; the longest decides (of equal length, the one with the longer host). Without a rule the
    vocabulary decides: block on one strict term or on `soft_limit` distinct soft terms, found by
    one Aho-Corasick walk over the url, each with a boundary on both sides. Terms are lower case.

    Rules and vocabulary are parameters that travel with the task, so they are meant for lists of
    up to some 100,000 entries. A null or empty url has empty host and path and is allowed. Repeated
    rows give repeated results; columns other than the two named are not read.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        top, _, rest = rule.partition("/")
        by_host.setdefault(top, []).append((f"/{rest}", rule, verdict))
    strict, soft = tuple(strict), tuple(soft)

    @F.arrow_udf(_JUDGED)
    def judged(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for urls, hosts, paths in batches:
            rows = []
            for url, h, p in zip(urls.to_pylist(), hosts.to_pylist(), paths.to_pylist()):
                rule, verdict = _best_rule(h, p, by_host)
                n_strict, n_soft = vocabulary_hits(url or "", strict, soft)
                if rule is None:
                    verdict = "block" if n_strict or n_soft >= soft_limit else "allow"
                rows.append((rule, verdict, n_strict, n_soft))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, _ARROW)], fields=list(_ARROW)
            )

    url = F.col("_url")
    return (
        pages.select(F.col(id_col), F.col(url_col).alias("_url"))
        .select(id_col, "_url", host(url).alias("host"), path(url).alias("path"))
        .withColumn("_judged", judged("_url", "host", "path"))
        .select(id_col, "host", "path", "_judged.*")
    )
