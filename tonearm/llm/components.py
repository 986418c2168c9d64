"""Distributed connected components by randomised contraction.

Every round each node picks the smallest of itself and its neighbours (by natural
order in odd rounds, which contracts stars at once, and by a hash that changes per
round in even ones, which contracts paths by a constant factor), and edges are
rewritten to the picked nodes.  Rounds run until no edge is left, so any diameter is
exact.  Each round's tables are written to the shared checkpoint folder; nothing but
row counts reaches the driver, and hub nodes go through the skew-proof look-up.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import lookup
from tonearm.session import drop_scratch, materialize


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of ``edges``; component is one node of it.

    Null ends and self-loops are ignored (such nodes are absent from the result);
    repeated edges and both directions are allowed; an empty table gives no rows.
    """
    a, b = F.col("u"), F.col("v")
    live = (edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter(a != b)
            .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    live = materialize(live, "cc-edges")
    picks = []
    while not live.isEmpty():
        both = live.unionByName(live.select(b.alias("u"), a.alias("v")))
        if len(picks) % 2 == 0:
            pick = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("rep"))
        else:
            seed = F.lit(len(picks))
            rank = lambda c: F.struct(F.xxhash64(seed, c).alias("h"), c.alias("n"))
            pick = (both.groupBy("u").agg(F.min(rank(b)).alias("m"))
                    .select("u", F.least(rank(a), F.col("m"))["n"].alias("rep")))
        pick = materialize(pick, "cc-pick")
        picks.append(pick)
        half = materialize(lookup(live, pick, "u", ["rep"]).select(F.col("rep").alias("ru"), "v"), "cc-half")
        full = lookup(half, pick.withColumnRenamed("u", "v"), "v", ["rep"])
        done, live = live, materialize(
            full.filter(F.col("ru") != F.col("rep"))
            .select(F.least("ru", "rep").alias("u"), F.greatest("ru", "rep").alias("v")).distinct(), "cc-edges")
        drop_scratch(done, half)
    if not picks:
        return live.select(a.alias("node"), b.alias("component"))
    # A node that stops appearing has reached its final representative, so the maps
    # are composed from the last round back to the first.
    total = picks[-1].select(a.alias("rep"), F.col("rep").alias("component"))
    for pick in reversed(picks[:-1]):
        step = lookup(pick, total, "rep", ["component"])
        step = step.select("u", F.coalesce("component", "rep").alias("component"))
        done, total = total, materialize(step.withColumnRenamed("u", "rep"), "cc-map")
        drop_scratch(done, pick)
    return total.withColumnRenamed("rep", "node")


def spanning_forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as values) reduced to one link per node to its component's least value."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left):]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    move = label != np.arange(len(nodes))
    return nodes[move], nodes[label[move]]
