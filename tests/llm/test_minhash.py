"""MinHash near duplicates against all pairs, and the posterior bounds."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from assaykit.llm import minhash
from assaykit.llm.jaccard import shingle_sets
from assaykit.llm.textbytes import buffers

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) == 1:
        return {tuple(words)}
    return set(zip(words, words[1:]))


def brute(rows):
    """(id, set size, component, kept) per row by comparing every pair that shares a shingle."""
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
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(df)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=repr)


def near_copies(seed, families=6, members=25):
    """Families of texts with growing edits, a passage that unrelated texts share, and short texts."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefgh") * rnd.randint(1, 3) + str(rnd.randint(0, 400))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rnd.randint(8, 120))]
        for _ in range(members):
            own = list(base)
            for _ in range(rnd.randint(0, 8)):
                at = rnd.randrange(len(own))
                own[at : at + rnd.randint(0, 1)] = [word()]
            texts.append(" ".join(own).upper() if rnd.random() < 0.2 else "\t ".join(own))
    for _ in range(40):
        texts.append(" ".join([word() for _ in range(rnd.randint(0, 30))] + passage))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = list(enumerate(near_copies(seed)))
    assert run(spark, rows) == brute(rows)


def test_hot_bands_and_many_slices(spark, monkeypatch):
    """Every key split, tiles of few sets: the same result."""
    monkeypatch.setattr(minhash, "SLICE", 5)
    monkeypatch.setattr(minhash, "LEAST_HOT", 3)
    rows = list(enumerate(near_copies(3, families=3, members=60)))
    assert run(spark, rows) == brute(rows)


def test_pairs_at_the_threshold(spark):
    """Isolated pairs of similarity 0.8 to 0.82, the hardest to find, and pairs just below."""
    rnd = random.Random(7)
    texts = []
    for size in range(8, 120):
        for share in (0.8, 0.79):
            words = [f"{rnd.getrandbits(40):x}" for _ in range(size + 1)]
            shared = math.ceil(size * share) if share == 0.8 else math.ceil(size * 0.8) - 1
            texts += [" ".join(words), " ".join(words[: shared + 1])]
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b"), (7, "a  B"), (8, "b a"),
        (9, "x y z u v"), (9, "x y z u v"), (None, "x y z u v"), (None, "lone words of no one here"), (None, None),
        (10, "Été d e f g h"), (11, "été d e f g h"), (12, "w " * 60_000), (13, "one one"),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_other_columns(spark):
    assert run(spark, []) == []
    rows = [(1, "a b c d e f", 5, "k", 1.0, 2, True), (2, "A b c d e f", 6, "l", 1.0, 2, False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size int, key string, a double, component_id int, kept boolean")
    assert sorted(map(tuple, minhash.near_duplicates(df).collect())) == [(1, 5, 1, True), (2, 5, 1, False)]


def test_posterior_is_the_tail_of_the_cut_beta():
    """Against a plain sum over similarities."""
    s = np.linspace(0, 1, 200_001)
    c = s + (1 - s) / minhash.BYTE
    for matches, compared in ((20, 32), (26, 32), (60, 64), (100, 160), (0, 32)):
        weight = c**matches * (1 - c) ** (compared - matches)
        assert minhash.posterior(matches, compared) == pytest.approx(weight[s >= 0.8].sum() / weight.sum(), rel=1e-3)


def test_batches_miss_what_they_may():
    """The chance that a pair at the threshold falls below a bar, batch by batch."""
    at = 0.8 + 0.2 / minhash.BYTE
    for n, bar in minhash.least_matches():
        lost = sum(math.comb(n, m) * at**m * (1 - at) ** (n - m) for m in range(bar))
        assert lost <= 2 * minhash.MISS
    bars = [bar / n for n, bar in minhash.least_matches()]
    assert bars == sorted(bars) and bars[0] > 0.3 and bars[-1] > 0.6


def test_batches_prune_unlike_pairs():
    rng = np.random.default_rng(2)
    left = rng.integers(0, 256, (1000, minhash.HASHES), dtype=np.uint8)
    right = left.copy()
    for i in range(1000):
        right[i, rng.random(minhash.HASHES) > (0.3 if i % 2 else 0.95)] += 1
    kept = minhash.survives(left, right, minhash.least_matches())
    assert kept[::2].all() and not kept[1::2].any()


def test_signatures_estimate_similarity():
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    texts, sims = [], []
    for _ in range(60):
        one = rnd.sample(words, 200)
        two = one[: rnd.randint(20, 200)] + rnd.sample(words, 10)
        x, y = shingles(" ".join(one)), shingles(" ".join(two))
        texts += [" ".join(one), " ".join(two)]
        sims.append(len(x & y) / len(x | y))
    tokens, sizes = shingle_sets(*buffers(pa.array(texts)), 2)
    sigs = minhash.signatures(tokens, sizes)
    guess = (sigs[::2] == sigs[1::2]).mean(1)
    assert abs(guess - sims).max() < 0.16 and abs((guess - sims).mean()) < 0.02


def test_family_below_the_threshold(spark):
    """Many sets whose similarity nearly reaches the threshold, pair by pair, beside a large component
    of the same family: no wrong links, and far fewer rows than pairs leave the tiles."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(80):
        own = list(base)
        for at in rnd.sample(range(60), 1 if i % 2 else 4):
            own[at] = f"x{rnd.getrandbits(30)}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)


def test_overlaps_and_stars():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in rng.integers(1, 400, 30)]
    found = minhash.overlaps(sets[:12], sets[12:])
    assert found.tolist() == [[len(np.intersect1d(x, y)) for y in sets[12:]] for x in sets[:12]]
    mask = np.zeros((3, 3), bool)
    mask[0, 1] = mask[2, 1] = mask[1, 2] = True
    a = np.array([10, 11, 12, 13, 14, 15])
    stars = minhash.star_edges(mask, np.array([0, 1, 2]), np.array([3, 4, 5]), a)
    assert sorted(zip(*stars.tolist())) == [(12, 10), (14, 10), (15, 11)]


def test_dense_tiles_equal_pairwise(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW_PAIRS", 0)
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    rows = list(enumerate(near_copies(5, families=3, members=40)))
    assert run(spark, rows) == brute(rows)
