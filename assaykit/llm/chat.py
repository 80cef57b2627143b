"""Conversations as training text in windows of a token budget, with a loss mask. DataFrame
functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit.session import cut

BUDGET = 1024
HISTORY = 256
CHARS_PER_TOKEN = 4
MARKS_PER_TURN = 4
# Tokens of a conversation that one row may hold, about a megabyte of text.
BLOCK = 1 << 18
# Long conversations named in a broadcast list; a longer list is joined.
LISTED = 100_000
SYSTEM = "system"
TARGET = "assistant"

# Control strings of the template; `<` never occurs in an escaped text.
NEW, PAST, END = "<turn>", "<past>", "</turn>"
ROLE, ROLE_END = "<role>", "</role>"


def escape(text: Column) -> Column:
    """`&` and `<` by entities, so that no text can hold a control string."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _render(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each turn with its rendered body and its tokens and characters."""
    body = F.concat(
        F.lit(ROLE), escape(F.col("role")), F.lit(ROLE_END), escape(F.col("text")), F.lit(END)
    )
    return (
        turns.select(
            F.col(conv).alias("conv"),
            F.col(turn).alias("turn"),
            F.col(role).alias("role0"),
            F.col(text).alias("text0"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        .withColumn("body", body)
        .withColumn("chars", F.length("body") + len(NEW))
        .withColumn(
            "tokens",
            F.ceil(F.length("text") / F.lit(CHARS_PER_TOKEN)).cast("long") + MARKS_PER_TURN,
        )
        .withColumn("head", F.length(escape(F.col("role"))) + len(NEW + ROLE + ROLE_END))
        .withColumn("size", F.length(escape(F.col("text"))))
        .drop("text")
    )


def _with_sums(rows: DataFrame, *group: str) -> DataFrame:
    """Place in the group, and the tokens and characters before it there."""
    order = Window.partitionBy(*group).orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role0"), F.asc_nulls_first("text0")
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {
            "pos": F.row_number().over(order).cast("long") - 1,
            "tokens_before": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
            "chars_before": F.coalesce(F.sum("chars").over(before), F.lit(0)),
        }
    ).drop("turn", "role0", "text0")


def _same_conv(left: DataFrame, right: DataFrame) -> Column:
    return left["conv"].eqNullSafe(right["named"])


def _in_parts(rows: DataFrame) -> DataFrame:
    """The sums of `_with_sums` over long conversations: turns are dealt to parts by ranges of their
    order, summed inside a part, and raised by the sums of the parts before it. No task sees a whole
    conversation. Turns that agree in conversation, turn, role and the first 64 characters share a
    part."""
    keys = [F.asc_nulls_first(c) for c in ("conv", "turn", "role0")]
    dealt = cut(
        rows.repartitionByRange(*keys, F.left("text0", F.lit(64)).asc_nulls_first()).withColumn(
            "part", F.spark_partition_id()
        )
    )
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("conv", "part").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("t"), F.sum("chars").alias("c")
    )
    raised = sizes.select(
        F.col("conv").alias("named"),
        F.col("part").alias("at_part"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("n", "t", "c")],
    )
    inside = _with_sums(dealt, "conv", "part")
    joined = inside.join(
        raised, _same_conv(inside, raised) & (inside["part"] == raised["at_part"])
    )
    return joined.withColumns(
        {
            "pos": F.col("pos") + F.col("n0"),
            "tokens_before": F.col("tokens_before") + F.col("t0"),
            "chars_before": F.col("chars_before") + F.col("c0"),
        }
    ).drop("named", "part", "at_part", "n0", "t0", "c0")


def _in_blocks(rows: DataFrame, block: int, history: int) -> DataFrame:
    """Turns of long conversations by block of `block` tokens. A block also holds, as past turns, the
    system turn and the turns before it that its first windows may repeat."""
    own = cut(
        rows.withColumns(
            {
                "block": F.floor(F.col("tokens_before") / F.lit(block)).cast("long"),
                "past": F.lit(False),
                "leads": (F.col("pos") == 0) & (F.col("role") == SYSTEM),
            }
        )
    )
    end = (F.col("block") + 1) * block
    latest = own.filter((F.col("tokens_before") >= end - history) & ~F.col("leads"))
    latest = latest.withColumn("block", F.col("block") + 1).withColumn("past", F.lit(True))
    later = own.filter("block > 0").select(F.col("conv").alias("named"), "block").distinct()
    system = own.filter("leads").drop("block")
    system = system.join(later, _same_conv(system, later)).drop("named")
    system = system.withColumn("past", F.lit(True))
    return own.unionByName(latest).unionByName(system).drop("leads")


def _by_block(rows: DataFrame, block: int, history: int) -> DataFrame:
    """Turns with their sums and blocks. A conversation of at most `block` tokens is one block."""
    totals = rows.groupBy(F.col("conv").alias("named")).agg(F.sum("tokens").alias("total"))
    long = cut(totals.filter(F.col("total") > block).select("named"))
    n_long = long.count()

    def plain(some: DataFrame) -> DataFrame:
        whole = _with_sums(some, "conv")
        return whole.withColumns({"block": F.lit(0).cast("long"), "past": F.lit(False)})

    if not n_long:
        return plain(rows)
    if n_long <= LISTED:
        long = F.broadcast(long)
    short = plain(rows.join(long, _same_conv(rows, long), "left_anti"))
    parts = _in_parts(rows.join(long, _same_conv(rows, long), "left_semi"))
    return short.unionByName(_in_blocks(parts, block, history))


def _starts(budget: int) -> Column:
    """Places at which a window starts: the next one when the tokens since the last start pass the
    room it has. A turn longer than the room stands alone."""
    first = F.col("lead").cast("int")
    zero = F.struct(
        F.array(first).alias("cuts"), F.get("turns", first)["tokens_before"].alias("base")
    )
    later = F.col("free") - F.col("reach")

    def step(acc: Column, i: Column) -> Column:
        t = F.get("turns", i)
        opening = (F.size(acc["cuts"]) == 1) & (F.col("block") == 0)
        room = F.when(opening, F.lit(budget)).otherwise(later)
        cut_here = (t["tokens_before"] + t["tokens"] - acc["base"] > room) & (
            i > F.element_at(acc["cuts"], -1)
        )
        opened = F.struct(
            F.concat(acc["cuts"], F.array(i)).alias("cuts"), t["tokens_before"].alias("base")
        )
        return F.when(cut_here, opened).otherwise(acc)

    places = F.sequence(first, F.size("turns") - 1)
    return F.aggregate(places, zero, step, lambda acc: acc["cuts"])


def _window(k: Column, history: int) -> Column:
    """Text and loss spans of the k-th window of a block."""
    turns, start = F.col("turns"), F.get("starts", k)
    stop = F.coalesce(F.get("starts", k + 1), F.size("turns"))
    reach = history // MARKS_PER_TURN + 1
    least = F.greatest(F.col("systems"), start - reach)
    at, last = F.get(turns, start), F.get(turns, stop - 1)
    fresh_tokens = last["tokens_before"] + last["tokens"] - at["tokens_before"]
    allowed = F.least(F.col("reach"), F.greatest(F.col("free") - fresh_tokens, F.lit(0)))
    near = F.filter(
        F.sequence(F.lit(0), F.lit(reach)),
        lambda b: (start - 1 - b >= least)
        & (at["tokens_before"] - F.get(turns, start - 1 - b)["tokens_before"] <= allowed),
    )
    first = start - F.size(near)
    repeated = F.when((k > 0) | (F.col("block") > 0), F.col("systems")).otherwise(0)
    kept = F.slice(turns, F.lit(1), repeated)
    past = F.concat(kept, F.slice(turns, first + 1, start - first))
    fresh = F.slice(turns, start + 1, stop - start)
    past_chars = F.aggregate(past, F.lit(0).cast("long"), lambda a, t: a + t["chars"])
    text = F.concat(
        F.array_join(F.transform(past, lambda t: F.concat(F.lit(PAST), t["body"])), ""),
        F.array_join(F.transform(fresh, lambda t: F.concat(F.lit(NEW), t["body"])), ""),
    )
    loss = F.transform(
        F.filter(fresh, lambda t: t["role"] == TARGET),
        lambda t: F.struct(
            (past_chars + t["chars_before"] - at["chars_before"] + t["head"]).alias("start"),
            t["size"].cast("long").alias("length"),
        ),
    )
    return F.struct(text.alias("formatted"), loss.alias("loss"))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    block: int = BLOCK,
) -> DataFrame:
    """(conv_id, window, formatted, loss): each conversation as windows of at most `budget` tokens.

    Turns are ordered by turn, then role and text; their tokens are estimated from characters, and
    prefix sums of them choose the spans: a window takes whole turns while they fit. Later windows
    first repeat a leading system turn and the latest turns of up to `history` tokens, tagged as
    past. `loss` holds (start, length) in code points of the assistant texts of a window's own turns;
    repeated ones carry no loss, so each is a target once.

    History takes at most half of what the system turn leaves of the budget. A turn that exceeds the
    room alone has a window of its own, with as much history as still fits. So a window passes the
    budget in two cases only, since turns are not cut: its one own turn is longer than the budget, or
    than what the repeated system turn leaves of it; it then repeats no history.

    A window also ends where `block` tokens of its conversation are full, so that a conversation of
    any length is dealt to many rows and tasks of bounded size. `window` ascends in a conversation; in
    one of a single block it counts from 0, later blocks start at multiples of `block`.

    Null text and role are empty. Rows with a null conversation id form one conversation. Repeated
    rows are turns of their own. An empty table has no windows. Other columns are not read.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be shorter than the budget")
    if block < 2 * budget:
        raise ValueError("a block must hold two budgets")
    fields = [
        "pos", "past", "role", "body", "head", "size",
        "tokens_before", "chars_before", "tokens", "chars",
    ]
    rendered = _render(turns, conv_col, turn_col, role_col, text_col)
    leader = F.get("turns", F.lit(0))
    whole = (
        _by_block(rendered, block, history)
        .groupBy("conv", "block")
        .agg(
            F.sort_array(F.collect_list(F.struct(*fields))).alias("turns"),
            F.count_if("past").alias("lead"),
        )
        .filter(F.col("lead") < F.size("turns"))
        .withColumn("systems", ((leader["pos"] == 0) & (leader["role"] == SYSTEM)).cast("int"))
        .withColumn("free", F.greatest(F.lit(budget) - F.col("systems") * leader["tokens"], F.lit(0)))
        .withColumn("reach", F.least(F.lit(history), F.floor(F.col("free") / 2)))
        .withColumn("starts", _starts(budget))
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("starts") - 1), lambda k: _window(k, history)
    )
    return whole.select(
        F.col("conv").alias(conv_col), "block", F.posexplode(windows).alias("_k", "_w")
    ).select(conv_col, (F.col("block") * block + F.col("_k")).alias("window"), "_w.*")


def read_windows(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, window, n, turns, target, chars) parsed from each formatted window: own turns only,
    `turns` with role and text each ended by a line feed, `target` the text under the loss mask."""
    own = F.filter(F.split("formatted", END), lambda p: F.startswith(p, F.lit(NEW)))

    def turn(p: Column) -> Column:
        inner = F.substr(p, F.lit(len(NEW + ROLE) + 1))
        at = F.instr(inner, F.lit(ROLE_END))
        role, text = F.substr(inner, F.lit(1), at - 1), F.substr(inner, at + len(ROLE_END))
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    target = F.transform(
        "loss", lambda s: F.substr(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))
    )
    return windows.select(
        conv_col,
        "window",
        F.size(own).cast("long").alias("n"),
        F.array_join(F.transform(own, turn), "").alias("turns"),
        unescape(F.array_join(target, "")).alias("target"),
        F.length("formatted").cast("long").alias("chars"),
    )


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, n_turns, turns, loss_text, formatted_chars): the windows of `read_windows` joined to
    one row a conversation, for digests of whole conversations; use `read_windows` where one may be
    longer than a row."""
    return read_windows(windows, conv_col).groupBy(conv_col).agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "target"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    ).select(
        conv_col,
        "n_turns",
        F.array_join(F.transform("w", lambda x: x["turns"]), "").alias("turns"),
        F.array_join(F.transform("w", lambda x: x["target"]), "").alias("loss_text"),
        "formatted_chars",
    )
