"""Connected components of an edge table, by contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge to another node.

    Each round points a node to its least neighbour, jumps once, and contracts the edges; a star is done
    in one round. A hub's edges meet only in a minimum (combined before the shuffle) and in joins that
    Spark can split.
    """
    at = scratch.keep(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"), f"{name}-edges-0")
    whole = None
    round_ = 0
    while not at.isEmpty():
        both = at.union(at.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to"))
        least = scratch.keep(least, f"{name}-least-{round_}")
        jump = least.select(F.col("node").alias("to"), F.col("to").alias("far"))
        step = scratch.keep(least.join(jump, "to").select("node", F.col("far").alias("to")), f"{name}-step-{round_}")
        if whole is None:
            whole = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            whole = scratch.keep(whole.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), f"{name}-whole-{round_}")
        of = lambda c: step.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        at = scratch.keep(at.join(of("a"), "a").join(of("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).where("a <> b").distinct(), f"{name}-edges-{round_ + 1}")
        round_ += 1
    return whole if whole is not None else at.select(F.col("a").alias("node"), F.col("b").alias("component"))
