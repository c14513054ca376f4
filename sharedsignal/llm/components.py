"""Connected components of a large edge table: alternating large-star and small-star rounds.

Each round is two aggregations with a map-side minimum and one join on the node;
a node with very many neighbours is one key of that join, which adaptive
execution splits.  Each round's edges are written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on directed rows (u, v): v's of u are linked to u's least neighbour."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges``; ``root`` is the least node of its component.

    Nodes without an edge have no row.  Self-links, repeated and null links are
    ignored.  Raises when ``most_rounds`` rounds do not settle (never seen: the
    number of rounds grows with the logarithm of the largest component).
    """
    now = scratch(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter(F.col("u") != F.col("v")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        step = scratch(_star(_star(now, True), False), "edges")
        s = step.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == (s["n"], s["h"]):
            return step.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                step.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state, now = (s["n"], s["h"]), step
    raise RuntimeError("components did not settle")
