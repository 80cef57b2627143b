"""How far the sources of a language differ in their use of its terms, in exact integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm.textbytes import buffers, pieces
from assaykit.session import cut

#: What stands between terms: every ASCII character that is not a letter.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 10
TERM_RANKS = 10
ONE = 1_000_000_000
#: Distinct (language, source, term) rows a task holds before it hands them on.
HELD = 400_000
#: Terms of a shard and sources of a block: a tile holds at most 2 * BLOCK * SHARD_TERMS counts.
SHARD_TERMS = 8192
BLOCK = 128
KEYS = ["lang", "source", "term"]


def _count(rows: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of one slice of documents."""
    lowered = pc.ascii_lower(rows.column(2))
    words = pc.split_pattern_regex(lowered, pattern=BETWEEN)
    parent, terms = pc.list_parent_indices(words), pc.list_flatten(words)
    some = pc.not_equal(terms, "")
    terms, parent = terms.filter(some).dictionary_encode(), parent.filter(some)
    langs, sources = (rows.column(i).dictionary_encode() for i in (0, 1))
    wide = max(len(sources.dictionary), 1)
    group = langs.indices.to_numpy().astype(np.int64) * wide + sources.indices.to_numpy()
    per_doc = pa.table({"doc": parent, "code": terms.indices}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    own = pa.array(group[per_doc.column("doc").to_numpy()])
    each = (
        pa.table({"group": own, "code": per_doc.column("code"), "n": per_doc.column("count_all")})
        .group_by(["group", "code"], use_threads=False)
        .aggregate([("n", "sum"), ([], "count_all")])
    )
    seen, n = np.unique(group, return_counts=True)
    at = np.concatenate([each.column("group").to_numpy(), seen])
    none = pa.nulls(len(seen), pa.large_string())
    return pa.table(
        {
            "lang": langs.dictionary.take(pa.array(at // wide)),
            "source": sources.dictionary.take(pa.array(at % wide)),
            "term": pa.chunked_array([*terms.dictionary.take(each.column("code")).chunks, none], pa.large_string()),
            "n": np.concatenate([each.column("n_sum").to_numpy(), np.zeros(len(seen), np.int64)]),
            "docs": np.concatenate([each.column("count_all").to_numpy(), n]),
        }
    )


def _merged(tables: list[pa.Table]) -> pa.Table:
    held = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return held.rename_columns([*KEYS, "n", "docs"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and the documents that
    hold it; and for each group a row with a null term that counts its documents.

    Tasks count in Arrow (lower-casing, splitting, dictionary codes, hash grouping), half a megabyte of
    text at a time or one longer text, and merge what they hold up to HELD rows, so one group with a
    third of all rows, or one term in all documents, is a few rows by the time it is shuffled.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = least = 0
        for batch in batches:
            columns = [c.cast(pa.large_string()).fill_null("") for c in batch.columns]
            whole = pa.RecordBatch.from_arrays(columns, names=["lang", "source", "text"])
            for low, high in pieces(buffers(columns[2])[1]):
                held.append(_count(whole.slice(low, high - low)))
                rows += len(held[-1])
                if rows - least > HELD:
                    held = [_merged(held)]
                    rows = least = len(held[0])
                    if rows > HELD:
                        yield from out(held.pop())
                        rows = least = 0
        if held:
            yield from out(_merged(held))

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = [*KEYS, "n", "docs"]
        kinds = [pa.string()] * 3 + [pa.int64()] * 2
        for batch in table.select(names).combine_chunks().to_batches(max_chunksize=50_000):
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(batch.columns, kinds)], names=names)

    own = docs.select(F.col(lang_col).cast("string").alias("l"), F.col(source_col).cast("string").alias("s"), F.col(text_col).alias("t"))
    partial = own.mapInArrow(scan, "lang string, source string, term string, n long, docs long")
    return partial.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(ONE * (count + 2) / total), by long division in steps of a thousand, which stays in 64
    bits up to a total of 9 * 10^15."""
    rest = counts.astype(np.int64) + 2
    out = rest // total
    rest = rest % total
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most ONE + 1, so the square fits in 64 bits."""
    gap = p - q
    return gap * gap // (p + q)


def _tile(cells: pa.Table, groups: pa.Table) -> tuple[dict[str, list], dict[str, list]]:
    """Sums of divergences over the terms of a tile for its pairs of sources, with the number of terms
    they cover; and, where a block meets itself, the leading terms of its groups."""
    block_i, block_j = (groups.column(c)[0].as_py() for c in ("bi", "bj"))
    names = groups.column("source").to_pylist()
    where = {s: i for i, s in enumerate(names)}
    block = groups.column("block").to_numpy()
    totals = (groups.column("n_terms").to_numpy() + 2 * groups.column("v").to_numpy()).tolist()
    terms = cells.column("term").combine_chunks().dictionary_encode()
    codes, vocabulary = terms.indices.to_numpy(), terms.dictionary
    counts = np.zeros((len(names), len(vocabulary)), np.int64)
    rows = np.array([where[s] for s in cells.column("source").to_pylist()], np.int64)
    counts[rows, codes] = cells.column("n").to_numpy()
    p = np.stack([shares(c, t) for c, t in zip(counts, totals)])
    pairs = {"source": [], "item": [], "value": [], "covered": []}
    left, right = np.flatnonzero(block == block_i), np.flatnonzero(block == block_j)
    for i in left.tolist():
        others = right[right > i] if block_i == block_j else right
        for j in others.tolist():
            value = int(divergence(p[i], p[j]).sum())
            for one, two in ((i, j), (j, i)):
                pairs["source"].append(names[one])
                pairs["item"].append(names[two])
                pairs["value"].append(value)
                pairs["covered"].append(len(vocabulary))
    tops = {"source": [], "item": [], "value": []}
    if block_i == block_j:
        overall = np.zeros(len(vocabulary), np.int64)
        overall[codes] = cells.column("lang_n").to_numpy()
        q = shares(overall, groups.column("lang_n")[0].as_py() + 2 * groups.column("v")[0].as_py())
        # terms in the order of their bytes, so that a stable sort by value settles ties
        spelled = np.argsort(np.array([t.encode() for t in vocabulary.to_pylist()], object), kind="stable")
        for i in left.tolist():
            able = spelled[(counts[i][spelled] > 0) & (p[i][spelled] > q[spelled])]
            value = divergence(p[i][able], q[able])
            for at in np.argsort(-value, kind="stable")[:TERM_RANKS].tolist():
                tops["source"].append(names[i])
                tops["item"].append(vocabulary[int(able[at])].as_py())
                tops["value"].append(int(value[at]))
    return pairs, tops


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) per language and source.

    Part `pair` has the divergence of the source from each other source of the language, over all kept
    terms; part `term` the terms that the source uses more than its language does, up to TERM_RANKS.
    A language keeps the terms that at least `least_docs` of its documents hold. Null texts, languages
    and sources are empty strings. A group without terms takes part; without kept terms all its
    distances are 0. Repeated rows are documents of their own. An empty table gives no rows. Other
    columns are not read. Counts in a language may reach 9 * 10^15.

    One scan counts in the tasks; merged counts are cut into shards of some SHARD_TERMS terms of a
    language, and those into tiles of two blocks of sources, so a tile is a matrix of bounded size and
    returns a sum for each pair of its sources. Terms that neither block holds are not in the tile;
    their share is the same for each of them and is added by number. A pair of every two sources of a
    language is the result asked for; it grows with the square of the sources.
    """
    counts = cut(term_counts(docs, text_col, lang_col, source_col))
    kept = (
        counts.filter("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n")
    )
    cells = cut(counts.filter("term IS NOT NULL").join(kept, ["lang", "term"]).select(*KEYS, "n", "lang_n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_n"))
    groups = cut(
        counts.filter("term IS NULL")
        .select("lang", "source")
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("n_terms")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["n_terms", "v", "lang_n"])
        .withColumn("block", F.expr(f"(row_number() OVER (PARTITION BY lang ORDER BY source) - 1) div {BLOCK}").cast("int"))
        .withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1)
        .withColumn("shards", F.ceil(F.col("v") / SHARD_TERMS).cast("int"))
    )
    # every pair of blocks that a source's block is in, the smaller first
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct(F.least(b, "block").alias("bi"), F.greatest(b, "block").alias("bj")),
    )
    placed = groups.select("*", F.explode(meets).alias("m")).select("*", "m.*").drop("m")
    keys = ["lang", "shard", "bi", "bj"]
    left = (
        cells.join(groups.select("lang", "source", "block", "blocks", "shards"), ["lang", "source"])
        .withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
        .select("*", F.explode(meets).alias("m"))
        .select(*keys[:2], "m.*", "source", "term", "n", "lang_n")
    )
    right = (
        placed.filter("shards > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
        .select(*keys, "source", "block", "n_terms", "v", "lang_n")
    )

    def tile(key: tuple, mine: pa.Table, sources: pa.Table) -> pa.Table:
        none = {"source": [], "item": [], "value": [], "covered": []}
        pairs, tops = _tile(mine, sources.sort_by("source")) if len(mine) and len(sources) else (none, none)
        n, m = len(pairs["source"]), len(tops["source"])
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * (n + m), pa.string()),
                "source": pa.array(pairs["source"] + tops["source"], pa.string()),
                "part": pa.array(["pair"] * n + ["term"] * m, pa.string()),
                "item": pa.array(pairs["item"] + tops["item"], pa.string()),
                "value": pa.array(pairs["value"] + tops["value"], pa.int64()),
                "covered": pa.array(pairs.get("covered", []) + [0] * m, pa.int64()),
            }
        )

    found = cut(
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(tile, "lang string, source string, part string, item string, value long, covered long")
    )
    # shares of a term that neither source has, from the groups alone
    facts = groups.select("lang", "source", "v", "blocks", (F.col("n_terms") + 2 * F.col("v")).alias("d"))
    two = facts.select("lang", "source", "v", F.when(F.col("d") > 0, F.expr(f"1 + (2 * {ONE}L) div greatest(d, 1)")).alias("p0"))
    mine = two.select("lang", "source", "v", F.col("p0").alias("p"))
    other = two.select("lang", F.col("source").alias("item"), F.col("p0").alias("q"))
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("s"), F.sum("covered").alias("c"))
    pairs = (
        mine.join(other, "lang")
        .filter("source <> item")
        .join(sums, ["lang", "source", "item"], "left")
        .select(
            "lang",
            "source",
            F.lit("pair").alias("part"),
            "item",
            F.expr(
                "CASE WHEN v = 0 THEN 0L ELSE coalesce(s, 0L) + (v - coalesce(c, 0L)) * ((p - q) * (p - q) div (p + q)) END"
            ).alias("value"),
        )
    )
    terms = found.filter("part = 'term'").select("lang", "source", "part", "item", "value")
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= TERM_RANKS)
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(ranked)
