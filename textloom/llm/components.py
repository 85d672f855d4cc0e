"""Connected components by alternating large-star and small-star.

Edges stay a distributed table throughout: the driver sees two numbers per
round. Each star is a ``min`` per node (combined before the shuffle) joined
back to the edges; the join key is the negated node id, so both sides of the
join are exchanged anew and adaptive execution can split a node that holds a
large share of all edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import discard, materialise


def _with_least(edges: DataFrame, least: Column) -> DataFrame:
    mins = edges.groupBy("u").agg(least.alias("m")).select((-F.col("u")).alias("k"), "m")
    return edges.withColumn("k", -F.col("u")).join(mins, "k")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = _with_least(both, F.min(F.least("u", "v")))
    return out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    out = _with_least(down, F.min("v"))
    moved = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(out.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (u long, v long).

    ``component`` is the smallest node reachable. Null ends, loops and
    repeated edges are ignored; no edges give no rows. The result is a table
    in the shared folder.
    """
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        big = materialise(_large_star(now), "edges")
        new = materialise(_small_star(big), "edges")
        discard(now, big)
        now = new
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select("v").distinct()
    out = materialise(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("component"))), "components")
    discard(now)
    return out
