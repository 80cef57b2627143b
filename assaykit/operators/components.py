"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.operators.skew import ROWS_PER_TASK, attach
from assaykit.session import cut

MAX_ROUNDS = 60


def _shape(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of nodes that keep the edge set from being a forest of stars: children
    with several parents, and parents that are children themselves."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(
        F.coalesce(F.sum("up"), F.lit(0)).alias("n"),
        F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).alias("odd"),
    ).first()
    return row["n"], row["odd"]


def _hook(edges: DataFrame, rows_per_task: int, total: int) -> DataFrame:
    """Every node hands its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("d"))
    return (
        attach(both, least, "a", F.col("b"), size="d", rows_per_task=rows_per_task, total=2 * total)
        .filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _contract(edges: DataFrame, rows_per_task: int, total: int) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("d"))
    moved = attach(
        down, least, "a", F.col("b"), size="d", rows_per_task=rows_per_task, total=total
    )
    return (
        moved.filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def connected_components(
    edges: DataFrame, rows_per_task: int = ROWS_PER_TASK, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """(node, component) for every node on an edge (a, b); the component is its smallest node.

    Each round is two pre-aggregated shuffles with a salted join each, written to the shared folder;
    the loop ends when only stars around their smallest node are left, which may be at once.
    """
    now = cut(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    total, odd = _shape(now)
    rounds = 0
    while odd:
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        rounds += 1
        # hooking gives at most one edge for each it reads
        hooked = _hook(now, rows_per_task, total)
        now = cut(_contract(hooked, rows_per_task, total))
        total, odd = _shape(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.union(roots)
