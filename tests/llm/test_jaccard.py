"""The Jaccard join against all pairs, and its bounds."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from assaykit.llm import jaccard
from assaykit.llm.textbytes import buffers

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(id, set size, component) per row by comparing every pair that shares a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for token in s:
            holders.setdefault(token, []).append(i)
    pairs = {(h[x], h[y]) for h in holders.values() for x in range(len(h)) for y in range(x + 1, len(h))}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)),
        key=repr,
    )


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, found), key=repr)


def near_copies(seed, families=6, members=25, shared=3):
    """Families of texts with growing edits, passages that unrelated texts share, and short texts."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefgh") * rnd.randint(1, 3) + str(rnd.randint(0, 400))
    passages = [[word() for _ in range(40)] for _ in range(shared)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rnd.randint(8, 120))]
        for _ in range(members):
            own = list(base)
            for _ in range(rnd.randint(0, 6)):
                at = rnd.randrange(len(own))
                own[at : at + rnd.randint(0, 1)] = [word()]
            texts.append(" ".join(own).upper() if rnd.random() < 0.2 else "  ".join(own))
    for _ in range(40):
        texts.append(" ".join([word() for _ in range(rnd.randint(0, 30))] + rnd.choice(passages)))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = list(enumerate(near_copies(seed)))
    assert run(spark, rows) == brute(rows)


def test_frequent_tokens_salts_and_slices(spark, monkeypatch):
    """Every bucket frequent, tiles cut into many slices: the same result."""
    monkeypatch.setattr(jaccard, "HOT_LEAST", 2)
    monkeypatch.setattr(jaccard, "HOT_SHARE", 10**9)
    monkeypatch.setattr(jaccard, "SLICE", 7)
    monkeypatch.setattr(jaccard, "SIGNED", 3)
    monkeypatch.setattr(jaccard, "LISTED", 0)
    rows = list(enumerate(near_copies(3, members=40)))
    assert run(spark, rows) == brute(rows)


def test_isolated_containment_pairs(spark):
    """Each text meets one other alone, itself and some words more: either may post what the other
    holds only beyond its first tokens."""
    rnd = random.Random(11)
    texts = []
    for size in range(3, 90):
        for share in (75, 80, 85, 90, 95):
            for more in {size * 100 // share - size, max(1, size * (100 - share) // share - 1)}:
                words = [f"{rnd.getrandbits(40):x}" for _ in range(size + 4 + more)]
                at = rnd.choice([0, more, more // 2])
                texts += [" ".join(words), " ".join(words[at : at + size + 4])]
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c"), (7, "a  b\nc"), (8, "a b c d"),
        (9, "x y z u v"), (9, "x y z u v"), (None, "x y z u v"), (None, "lone words of no one here"), (None, None),
        (10, "Été d e f g h"), (11, "été d e f g h"), (12, "w " * 60_000),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(none).collect() == []
    rows = [(1, "a b c d e f", 5, "k", 1.0, 2), (2, "A b c d e f", 6, "l", 1.0, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size int, key string, a double, component_id int")
    found = jaccard.jaccard_components(df).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1)]


def test_bound_never_below_overlap():
    rnd = np.random.default_rng(5)
    for _ in range(200):
        pool = rnd.integers(0, 1 << 63, 300, dtype=np.uint64)
        x, y = (np.unique(rnd.choice(pool, rnd.integers(1, 250))) for _ in range(2))
        sigs = [jaccard.signature(s) for s in (x, y)]
        bits = min(8 * len(s) for s in sigs)
        left, right = jaccard._folded(sigs[:1], bits), jaccard._folded(sigs[1:], bits)
        most = jaccard.overlap_bound(left, right, np.array([len(x)]), np.array([len(y)]))[0]
        assert most >= len(np.intersect1d(x, y))


def test_sets_are_exact():
    texts = [*near_copies(7), None, "", "a b", "a b a b a b a b"]
    data, off = buffers(pa.array(texts))
    _, sizes = jaccard.shingle_sets(data, off)
    assert sizes.tolist() == [len(shingles(t)) for t in texts]


def test_buckets_of_two_are_one_pair_and_tiles_count_shared_buckets(spark):
    """Texts that share a few shingles with many others, none enough: before, each such meeting was a row in
    all later steps, and every pair of a tile was held against whole signatures."""
    rnd = random.Random(9)
    word = lambda: f"{rnd.getrandbits(40):x}"
    lines = [[word() for _ in range(9)] for _ in range(30)]
    texts = [[w for _ in range(12) for w in [*rnd.choice(lines), *(word() for _ in range(5))]] for _ in range(60)]
    two = [word() for _ in range(80)]
    texts += [two, [*two[:-2], word()], [*two[:20], *(word() for _ in range(60))]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "xxhash64(text) AS text_hash", "text")
    facts = jaccard._facts(docs).cache()
    sets = facts.filter("sig IS NOT NULL").selectExpr("a", "cast(size AS int) AS size", "sig").dropDuplicates(["a"])
    postings = jaccard._postings(docs, jaccard._hot_buckets(facts, 10**9), 75, 100, 16).cache()
    twos, live = jaccard._live(postings, sets.select("a", "size"), 75, 100)
    name = {r.a: r.id for r in facts.filter("size IS NOT NULL").collect()}
    assert {frozenset((name[r.a], name[r.b])) for r in twos.collect()} >= {frozenset((60, 61))}
    buckets = {}
    for r in live.collect():
        buckets.setdefault(r.bucket, set()).add(r.a)
    assert min(map(len, buckets.values())) > 2
    labels = spark.createDataFrame([], "node long, component long")
    posted, found = {}, {(r.a, r.b) for r in jaccard._tile_pairs(live, labels, sets, 75, 100).collect()}
    for r in postings.distinct().collect():
        posted.setdefault(r.a, set()).add(r.key >> jaccard.SALT_BITS)
    size = {r.a: r.size for r in sets.collect()}
    for a, b in found:
        both = -(-75 * (size[a] + size[b]) // 175)
        assert len(posted[a] & posted[b]) >= both - (3 * max(size[a], size[b]) + 3) // 4 + 1
    assert len(found) < 60 * 59 // 8
    assert run(spark, rows) == brute(rows)
