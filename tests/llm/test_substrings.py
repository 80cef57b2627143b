"""Content-defined chunks: repeats found wherever they stand, clean texts left alone."""

import random
import re

import numpy as np
import pyarrow as pa

from assaykit.llm import bitmaps, substrings
from assaykit.llm.textbytes import buffers


def chunks(text):
    data, off = buffers(pa.array([text]))
    part, sizes, _ = substrings.normalised(data, off)
    ends = substrings.chunk_ends(part, sizes)
    return [part[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def slow(text, least=substrings.LEAST_CHUNK):
    body = re.sub(r"[\x09-\x0d\x20]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).encode()
    is_end = lambda p: p == len(body) or body[p] & 0xC0 != 0x80
    h, keys, ends = 0, {}, []
    for i, b in enumerate(body):
        h = (h * 2 + int(substrings._GEAR[b])) & 0xFFFF
        if is_end(i + 1):
            keys[i] = (h, i)
    for i in keys:
        if i + 1 >= least and keys[i] == min(keys[j] for j in range(i - least, i + least + 1) if j in keys):
            ends.append(i + 1)
    out, at = [], 0
    for end in [e for e in ends if e < len(body)] + [len(body)]:
        base, step = at, 1
        while end - base > substrings.MOST_CHUNK * step:
            p = base + substrings.MOST_CHUNK * step
            while not is_end(p):
                p -= 1
            out.append(body[at:p])
            at, step = p, step + 1
        out.append(body[at:end])
        at = end
    return out


def prose(rnd, n, least=2, most=8):
    return " ".join("".join(rnd.choices("abcdefghijkl", k=rnd.randint(least, most))) for _ in range(n))


def test_chunks_equal_a_byte_loop_and_resist_insertions():
    rnd = random.Random(1)
    text = prose(rnd, 400)
    wide = "".join(rnd.choices("aé漢😀 Z\n", k=3000))
    for t in (text, wide, "a" * 1000, "漢" * 500, "x"):
        assert chunks(t) == slow(t)
    assert all(len(c) <= substrings.MOST_CHUNK + 3 for c in chunks(wide) + chunks("漢" * 500))
    assert b"".join(chunks(text)) == text.encode()
    assert len(set(chunks(text)) & set(chunks("inserted " + text))) > 0.9 * len(set(chunks(text)))


def test_repeats(spark):
    rnd = random.Random(2)
    passages = [prose(rnd, 55) for _ in range(20)]
    rows = [(i, prose(rnd, rnd.randint(5, 200)), "x") for i in range(60)]
    holders = set()
    for i, passage in enumerate(passages):
        for doc in (i, 20 + i):
            words = rows[doc][1].split()
            words.insert(rnd.randint(0, len(words)), passage.upper().replace(" ", "\n  ") if doc % 2 else passage)
            rows[doc] = (doc, " ".join(words) if doc % 3 else "  ".join(words), "x")
            holders.add(doc)
    rows += [(100, None, "y"), (101, "", "y"), (102, "tiny", "y"), (103, prose(rnd, 20) * 1, "y"), (None, passages[0], "z")]
    rows += [(104, "one line repeated inside " * 50, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    found = substrings.repeated_spans(df).collect()
    assert {r.doc_id for r in found} == holders | {None}
    assert {r.first for r in found} == {True, False} and all(r.n_bytes >= 80 for r in found)
    assert substrings.repeated_spans(df.limit(0)).collect() == []
    assert substrings.drop_repeats(df.limit(0)).collect() == []


def test_recall_by_length_and_no_false_byte(spark):
    """Passages in two rows each, at any place, with accented and wide letters around them: what is
    found holds nothing else, and ends with whole words."""
    rnd = random.Random(4)
    rows, where = [], {}
    for i in range(3000):
        words = (20, 30, 50, 80)[i % 4]
        passage = prose(rnd, words, 2, 5)
        for j in (0, 1):
            head, tail = prose(rnd, rnd.randint(0, 30)) + f" é漢😀{i}{'xy'[j]} ", f" {'yx'[j]}{i}漢 " + prose(rnd, rnd.randint(0, 30))
            rows.append((2 * i + j, head + (passage.replace(" ", "\t ") if j else passage) + tail))
            where[2 * i + j] = (words, len(head), len(rows[-1][1]) - len(tail), len(passage))
    found = substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text, hit, share = dict(rows), {}, []
    for r in found:
        words, low, high, size = where[r.doc_id]
        assert low - 1 <= r.start and r.start + r.length <= high + 1
        span = text[r.doc_id][r.start : r.start + r.length]
        assert " ".join(span.split()) in " ".join(text[r.doc_id ^ 1].split())
        hit.setdefault(words, set()).add(r.doc_id)
        share.append(r.n_bytes / size)
    recall = {w: len(hit[w]) / 1500 for w in hit}
    assert recall[50] > 0.99 and recall[80] > 0.999 and recall[30] > 0.9
    assert np.mean(share) > 0.97, (recall, np.mean(share))


def test_copies_are_cut_and_the_first_stays(spark):
    rnd = random.Random(3)
    text, other, passage = prose(rnd, 60), prose(rnd, 60), prose(rnd, 70)
    rows = [(1, text, "a"), (1, text, "a"), (2, other, "b"), (3, f"{prose(rnd, 9)} {passage}", "c")]
    rows += [(4, f"before {passage} after", "d"), (5, None, "e"), (6, "", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").coalesce(1)
    found = [(r.doc_id, r.first) for r in substrings.repeated_spans(df).collect()]
    assert sorted(found) == [(1, False), (1, True), (3, True), (4, False)]
    got = substrings.drop_repeats(df).collect()
    assert sorted((r.doc_id, r.row) for r in got) == sorted((r[0], r[2]) for r in rows)
    assert sorted(r.text for r in got if r.doc_id == 1) == ["", text]
    left = {r.doc_id: r.text for r in got if r.doc_id > 1}
    assert left[2] == other and left[3] == rows[3][1] and left[5] is None and left[6] == ""
    assert left[4].split()[0] == "before" and left[4].split()[-1] == "after" and len(left[4]) < 30


def test_frequent_claims_are_counted_apart_with_the_same_result(spark, monkeypatch):
    """Boilerplate in every row and passages in few, with all claims in one exchange, some apart, all apart."""
    rnd = random.Random(6)
    line, passages = prose(rnd, 40), [prose(rnd, 40) for _ in range(10)]
    rows = [(i, f"{prose(rnd, 20)} {line} {prose(rnd, 9)} {passages[i % 10]} {prose(rnd, 9)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id").cache()
    found = {}
    for least, share in ((10**6, 1), (25, 100), (1, 10**9)):
        monkeypatch.setattr(substrings, "HOT_LEAST", least)
        monkeypatch.setattr(substrings, "HOT_SHARE", share)
        found[least] = sorted(map(tuple, substrings.repeated_spans(df).collect()))
    assert len({r[0] for r in found[1]}) == 60
    assert found[10**6] == found[25] == found[1]


def test_claims_cross_one_exchange_with_their_digest(spark):
    """Unless they are frequent; the first count of chunks is written before."""
    rnd = random.Random(7)
    passage = prose(rnd, 40)
    rows = [(i, f"{prose(rnd, 20)} {passage} {prose(rnd, 9)}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plan = substrings.repeated_spans(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(digest") == 1


def test_few_others_pass_a_bitmap_of_many_digests():
    """As 2.1 million digests, which 0.5 GB of texts holds twice, did: 3 in 100 other chunks then passed,
    and each was looked up with all words around it."""
    rnd = np.random.default_rng(8)
    hashes, others = (rnd.integers(-(2**63), 2**63, n) for n in (1 << 21, 1 << 18))
    bits = bitmaps.bits_for(len(hashes))
    words, marks = hashes.view(np.uint64) >> np.uint64(64 - bits + 6), np.zeros(len(hashes), np.uint64)
    for i in range(bitmaps.PROBES):
        marks |= np.uint64(1) << (hashes.view(np.uint64) >> np.uint64(6 * i) & np.uint64(63))
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    np.bitwise_or.at(bitmap, words.astype(np.int64), marks)
    assert bitmaps.passes(bitmap, hashes).all()
    assert bitmaps.passes(bitmap, others).mean() < 0.005
    assert bitmaps.bits_for(0) == bitmaps.BITS and bitmaps.bits_for(10**12) == bitmaps.MOST_BITS


def test_bitmap_of_a_table_passes_its_hashes(spark):
    rows = spark.range(-3000, 3000).selectExpr("IF(id % 7 = 0, NULL, xxhash64(id)) AS h")
    own = np.array([r.h for r in rows.filter("h IS NOT NULL").collect()])
    other = np.array([r.h for r in spark.range(10**6, 10**6 + 5000).selectExpr("xxhash64(id) AS h").collect()])
    for bits in (bitmaps.BITS, bitmaps.BITS + 1):
        bitmap = bitmaps.build(rows, "h", bits)
        assert len(bitmap) == 1 << (bits - 6) and bitmaps.passes(bitmap, own).all()
        assert not bitmaps.passes(bitmap, other).any()


def test_frequent_claims_are_united_before_they_are_dealt_out(spark, monkeypatch):
    """Each was a row of a join before. Few shared digests are looked up in place, many joined once a batch; a
    copy of 80 KB is one stretch in both."""
    rnd = random.Random(9)
    line, long = prose(rnd, 60), prose(rnd, 15000)
    rows = [(i, f"{prose(rnd, 9)} {line} {prose(rnd, 9)}") for i in range(300)] + [(300, long), (301, f"é {long}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id").cache()
    joined, own, found, few = [], substrings.attach, {}, substrings.BROADCAST_KEYS

    def attach(rows, facts, *args, **kwargs):
        most = rows.groupBy("digest").count().agg({"count": "max"}).first()[0]
        joined.append((most, facts.agg({"n": "max"}).first()[0]))
        return own(rows, facts, *args, **kwargs)

    monkeypatch.setattr(substrings, "attach", attach)
    for least, share, most in ((10**6, 1, few), (1, 10**9, few), (1, 10**9, 0)):
        monkeypatch.setattr(substrings, "HOT_LEAST", least)
        monkeypatch.setattr(substrings, "HOT_SHARE", share)
        monkeypatch.setattr(substrings, "BROADCAST_KEYS", most)
        found[least, most] = sorted(map(tuple, substrings.repeated_spans(df).collect()))
    assert len(joined) == 1 and joined[0][0] <= 4 and joined[0][1] == 300
    assert found[10**6, few] == found[1, few] == found[1, 0]
    assert [r[2] for r in found[1, few] if r[0] in (300, 301)] == [len(long)] * 2
    assert {r[0] for r in found[1, few]} == set(range(302))


def test_united_stretches_equal_a_loop():
    rnd = np.random.default_rng(10)
    for n in (0, 1, 50, 2000):
        row, first = rnd.integers(0, 1 + n // 20, n), rnd.random(n) < 0.5
        low, size = rnd.integers(0, 400, n), rnd.integers(16, 60, n)
        packed = low << 32 | size
        slow, at = [], None
        for r, f, a, b in sorted(zip(row.tolist(), first.tolist(), low.tolist(), (low + size).tolist())):
            if at == (r, f) and a <= slow[-1][3] - substrings.LEAST_CHUNK:
                slow[-1][3] = max(slow[-1][3], b)
            else:
                slow.append([r, f, a, b])
            at = (r, f)
        row, first, points, place = substrings._united(row, first, packed, packed)
        assert (points == place).all()
        low = place >> 32
        assert [list(x) for x in zip(row.tolist(), first.tolist(), low.tolist(), (low + (place & substrings.LENGTH)).tolist())] == slow
