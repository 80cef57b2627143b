import random

import pytest

from assaykit.operators import similarity
from assaykit.operators.components import connected_components
from assaykit.operators.similarity import (
    lsh_layout,
    near_duplicate_components,
    near_duplicate_lsh_components,
    one_permutation,
)


def components_by_hand(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            for n in (a, b):
                if label[n] != low:
                    label[n] = low
                    changed = True
    return label


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rows_per_task", [3, 1_000_000])
def test_components(spark, seed, rows_per_task):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    edges += [(100, i) for i in range(101, 130)]  # a hub
    edges += [(i, i + 1) for i in range(200, 220)]  # a chain
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), rows_per_task)
    linked = [(a, b) for a, b in edges if a != b]
    want = components_by_hand({n for e in linked for n in e}, linked)
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(text):
    words = text.split()
    if 0 < len(words) < 3:
        return {tuple(words)}
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def family(rng, n, length, edits):
    base = [f"w{rng.randrange(40)}" for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(length)] = f"x{rng.randrange(1000)}"
        out.append(" ".join(copy))
    return out


def corpus(seed):
    """A third of the documents are near copies of one text; others share a template that keeps them
    just below the threshold; the rest are small families, exact copies and short texts."""
    rng = random.Random(seed)
    docs = family(rng, 30, 60, 3)
    template = [f"t{i}" for i in range(50)]
    docs += [" ".join(template + [f"u{i}_{j}" for j in range(12)]) for i in range(15)]
    for _ in range(8):
        docs += family(rng, 3, rng.randrange(20, 60), 4)
    docs += [docs[0]] * 6 + [docs[3] + " "] * 2 + ["one two", "one two", "one  two", "solo", " solo", "", "a b c", "a  b\nc"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def want_components(docs, threshold):
    first, sets = {}, {}
    for i, text in docs:
        if text not in first and sets_of(text):
            first[text] = i
            sets[i] = sets_of(text)
    edges = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9
    ]
    return components_by_hand({n for e in edges for n in e}, edges)


@pytest.mark.parametrize("seed,rows_per_task,threshold", [(0, 10**6, 0.8), (1, 4, 0.8), (2, 4, 0.6)])
def test_near_components_equal_brute_force(spark, seed, rows_per_task, threshold):
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = near_duplicate_components(frame, threshold=threshold, rows_per_task=rows_per_task)
    assert {r["node"]: r["component"] for r in got.collect()} == want_components(docs, threshold)


def test_lsh_never_joins_what_is_apart(spark):
    docs = corpus(5)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    exact = want_components(docs, 0.8)
    got = near_duplicate_lsh_components(frame).collect()
    assert got
    by_component = {}
    for row in got:
        by_component.setdefault(row["component"], set()).add(exact[row["node"]])
    assert all(len(found) == 1 for found in by_component.values())


def test_lsh_recall(spark):
    """Pairs at the threshold and above: nearly all are found, and the layout promises it."""
    rnd = random.Random(12)
    docs, want = [], 0
    for i in range(300):
        words = [f"{rnd.getrandbits(30):x}" for _ in range(rnd.randint(8, 80))]
        kept = max(len(words) - rnd.randint(0, max(0, (len(words) - 2) // 5)), 3)
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:kept]))]
        want += kept < len(words)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    exact = near_duplicate_components(frame).count()
    found = near_duplicate_lsh_components(frame).count()
    assert exact == 2 * want and found >= 0.95 * exact
    bands, rows = lsh_layout(0.8, 0.95)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.95 > 1 - (1 - 0.8 ** (rows + 1)) ** (32 // (rows + 1))


def test_one_permutation_signatures_estimate_similarity(spark):
    rnd = random.Random(3)
    rows, sims = [], []
    for i in range(120):
        x = {rnd.getrandbits(62) for _ in range(rnd.choice([3, 20, 200]))}
        y = set(rnd.sample(sorted(x), max(1, int(len(x) * rnd.random())))) | {rnd.getrandbits(62) for _ in range(2)}
        rows += [(2 * i, len(x), sorted(x)), (2 * i + 1, len(y), sorted(y))]
        sims.append(len(x & y) / len(x | y))
    frame = spark.createDataFrame(rows, "node long, size int, tokens array<long>")
    sigs = {r["node"]: r["signature"] for r in one_permutation(frame).collect()}
    assert all(len(s) == 32 and None not in s for s in sigs.values())
    guess = [sum(p == q for p, q in zip(sigs[2 * i], sigs[2 * i + 1])) / 32 for i in range(120)]
    errors = [g - s for g, s in zip(guess, sims)]
    assert abs(sum(errors) / len(errors)) < 0.03


@pytest.mark.parametrize("bits,listed", [(1, 0), (6, 10**6)])
def test_any_order_of_tokens_and_any_list_gives_the_same(spark, monkeypatch, bits, listed):
    """Counts too coarse to tell tokens apart, batches of a few sets, and lists too long to be sent out."""
    monkeypatch.setattr(similarity, "COUNT_BITS", bits)
    monkeypatch.setattr(similarity, "BATCH", 40)
    monkeypatch.setattr(similarity, "LISTED", listed)
    docs = corpus(7)
    # the same row twice, a copy under a larger id, and rows without id or text
    rows = docs + [docs[0], docs[5], (1000, docs[5][1]), (None, "a b c d"), (1001, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicate_components(frame)
    assert {r["node"]: r["component"] for r in got.collect()} == want_components(docs, 0.8)
    assert got.count() == len(want_components(docs, 0.8))


def test_texts_stay_in_the_scan(spark, tmp_path):
    spark.createDataFrame(corpus(1), "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    texts = similarity.distinct_texts(spark.read.parquet(str(tmp_path / "docs")), "doc_id", "text")
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    assert texts.count() == len({t for _, t in corpus(1)})


def test_only_first_tokens_are_shuffled(spark):
    """Every token goes into counts of fixed size; rows of tokens are those posted and shared."""
    docs = [(i, " ".join(f"w{i}_{j}" for j in range(200))) for i in range(20)]
    docs += [(100 + i, " ".join([f"v{j}" for j in range(200)] + [f"x{i}"])) for i in range(3)]
    sets = similarity.distinct_sets(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    posted = similarity.prefix_postings(sets, 0.8, 10**6)
    assert posted.columns == ["token", "node", "size"]
    assert {r["node"] for r in posted.collect()} == {100, 101, 102}
    assert posted.groupBy("node").count().agg({"count": "max"}).first()[0] <= 200 - 160 + 1
    tokens = posted._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in tokens and "collect_list" not in tokens
