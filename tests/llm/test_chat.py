"""Chat windows: round trip, budget, targets once."""

import hashlib
import random

from pyspark.sql import functions as F

from assaykit.llm import chat
from assaykit.llm.queries import PROBE

SCHEMA = "conv_id long, turn long, role string, text string, pos int, body string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)


def wanted(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = ((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or ""))
        out.setdefault(conv, []).append((key, role or "", text or ""))
    done = {}
    for conv, turns in out.items():
        turns = [t[1:] for t in sorted(turns)]
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        done[conv] = (len(turns), whole, "".join(t for r, t in turns if r == "assistant"))
    return done


def random_rows(seed):
    rnd = random.Random(seed)
    pieces = ["<", "</turn>", "<turn>", "<past>", "<role>", "&", "&lt;", "&amp;lt;", "\\", "\n", "é", "word ", PROBE, " "]
    rows = []
    for conv in range(25):
        roles = (["system"] if rnd.random() < 0.5 else []) + ["user", "assistant"] * rnd.randint(1, 12)
        for turn, role in enumerate(roles):
            rows.append((conv, turn, role, "".join(rnd.choices(pieces, k=rnd.choice([0, 3, 30, 120])))))
    return rows


def test_round_trip(spark):
    rows = random_rows(1) + [
        (None, 1, "user", "no id"), (None, 2, "assistant", None), (100, None, None, "x"), (100, None, "assistant", "a"),
        (100, 3, "assistant", "twice"), (100, 3, "assistant", "twice"), (101, 0, "assistant", ""), (102, 0, "user", None),
        (103, 0, "a<b&</role>", "odd role"), (104, 0, "user", "long " * 50_000),
    ]
    for budget, history in ((64, 16), (1024, 256), (50, 0)):
        windows = chat.format_conversations(frame(spark, rows), budget=budget, history=history).cache()
        got = {r.conv_id: (r.n_turns, r.turns, r.loss_text) for r in chat.read_back(windows).collect()}
        assert got == wanted(rows)
        assert windows.filter(F.size(F.split("formatted", "</?past>")) < 0).count() == 0
        windows.unpersist()


def test_budget_system_and_history(spark):
    rows = [(1, 0, "system", "s" * 40)] + [(1, i, ("user", "assistant")[i % 2], f"{i:02d}" * 20) for i in range(1, 40)]
    cost = 40 // chat.CHARS_PER_TOKEN + chat.MARKS_PER_TURN
    windows = chat.format_conversations(frame(spark, rows), budget=10 * cost, history=3 * cost).orderBy("window").collect()
    assert len(windows) > 3
    for i, w in enumerate(windows):
        parts = w.formatted.split("</turn>")[:-1]
        assert len(parts) <= 10
        past = [p for p in parts if p.startswith("<past>")]
        if i:
            assert "<role>system</role>" in past[0] and len(past) == 4
        texts = [w.formatted[s.start : s.start + s.length] for s in w.loss]
        assert texts == [p.split("</role>")[1] for p in parts if p.startswith("<turn><role>assistant")]


def test_probe_and_empty(spark):
    rows = [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    got = chat.read_back(chat.format_conversations(frame(spark, rows))).collect()[0]
    assert (got.n_turns, got.loss_text) == (2, PROBE)
    assert hashlib.sha256(got.turns.encode()).hexdigest() == hashlib.sha256(f"user\n{PROBE}\nassistant\n{PROBE}\n".encode()).hexdigest()
    assert chat.format_conversations(frame(spark, rows).limit(0)).collect() == []


def plain_windows(rows, budget, history, block):
    """The windows of each conversation by a plain loop: (past, own) lists of (role, text)."""
    out = {}
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, role, text))
    for conv, turns in groups.items():
        turns = sorted(turns)
        cost = [-(-len(t[2]) // chat.CHARS_PER_TOKEN) + chat.MARKS_PER_TURN for t in turns]
        before = [sum(cost[:i]) for i in range(len(turns))]
        system = turns[0][1] == "system"
        free = max(budget - (cost[0] if system else 0), 0)
        reach = min(history, free // 2)
        cuts, room = [0], budget
        for i in range(1, len(turns)):
            full = before[i] + cost[i] - before[cuts[-1]] > room
            if full or before[i] // block > before[cuts[-1]] // block:
                cuts.append(i)
                room = free - reach
        done = []
        for start, stop in zip(cuts, cuts[1:] + [len(turns)]):
            allowed = min(reach, max(free - sum(cost[start:stop]), 0))
            past = [i for i in range(int(system), start) if before[start] - before[i] <= allowed]
            past = ([0] if system and start else []) + past
            done.append(([turns[i][1:] for i in past], [t[1:] for t in turns[start:stop]]))
            if start and sum(cost[i] for i in past) + sum(cost[start:stop]) > budget:
                assert stop - start == 1 and len(past) <= int(system)
        out[conv] = done
    return out


def parsed(windows):
    out = {}
    for w in windows.orderBy("conv_id", "window").collect():
        sides = ([], [])
        for part in w.formatted.split("</turn>")[:-1]:
            mark, _, rest = part.partition("<role>")
            role, _, text = rest.partition("</role>")
            sides[mark == "<turn>"].append((role, text))
        assert [w.formatted[s.start : s.start + s.length] for s in w.loss] == [t for r, t in sides[1] if r == "assistant"]
        out.setdefault(w.conv_id, []).append(sides)
    return out


def test_windows_equal_a_plain_loop_in_blocks(spark):
    """Long conversations are split over blocks; system turns of every size up to beyond the budget."""
    rnd = random.Random(5)
    rows = []
    for conv in range(12):
        if conv % 3:
            rows.append((conv, 0, "system", "s" * rnd.choice([0, 40, 150, 190, 240, 400])))
        n = 300 if conv == 7 else rnd.randint(1, 60)
        rows += [(conv, i, ("user", "assistant")[i % 2], f"{i}." + "x" * rnd.choice([0, 8, 60, 250, 900])) for i in range(1, n)]
    for budget, history, block in ((64, 16, 128), (64, 40, 1 << 18), (64, 0, 300)):
        got = parsed(chat.format_conversations(frame(spark, rows), budget=budget, history=history, block=block))
        assert got == plain_windows(rows, budget, history, block)


def test_system_turn_near_the_budget(spark):
    rows = [(1, 0, "system", "s" * 4000)] + [(1, i, "assistant", "a" * 40) for i in range(1, 9)]
    for w in chat.format_conversations(frame(spark, rows)).collect():
        tokens = sum(-(-len(p.split("</role>")[1]) // 4) + 4 for p in w.formatted.split("</turn>")[:-1])
        assert tokens <= chat.BUDGET


def test_hot_and_null_conversation_in_many_blocks(spark):
    rows = [(None, i, ("user", "assistant")[i % 2], f"turn {i} " * 6) for i in range(400)]
    rows += [(3, i, "assistant", "same") for i in (0, 0, 0, 1)] + [(None, 399, "assistant", "turn 399 " * 6)] * 30
    windows = chat.format_conversations(frame(spark, rows), budget=64, history=16, block=256).cache()
    got = {r.conv_id: (r.n_turns, r.turns, r.loss_text) for r in chat.read_back(windows).collect()}
    assert got == wanted(rows)
    assert windows.filter("conv_id is null").agg(F.max("window")).first()[0] >= 256 * 10
    assert windows.agg(F.max(F.length("formatted"))).first()[0] < 2_000
    windows.unpersist()
