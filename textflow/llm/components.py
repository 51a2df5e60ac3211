"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm.tables import discard, written


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each `u` the smallest of itself and its neighbours `v`, written: both sides of the next join are
    then plain tables, in which Spark can split a node with very many neighbours."""
    return written(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star")


def _settled(edges: DataFrame) -> bool:
    """Whether each node is linked to one other alone and none of these is linked on: the components are stars."""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    return not several and not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()


def components(edges: DataFrame, most_rounds: int = 100, exact: bool = True) -> DataFrame:
    """`node, component` for each node of the edges `u, v` (longs): the component's smallest node.

    Large-star links the larger neighbours of each node to its smallest neighbour, small-star the smaller ones
    and the node itself; both keep components together, and in about log2(n) rounds every node is linked to the
    smallest one of its component alone, with which the rounds end. Each step sends rows of two longs, reduced in
    the tasks first. Loops, repeated edges and null ends are left out; no edges give no rows.

    Without `exact`, `most_rounds` rounds are made: nodes of equal components are then connected, but a component
    may still have several names.
    """
    clean = edges.filter("u is not null and v is not null and u != v")
    current = written(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        if exact and _settled(current):
            break
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        star = _smallest(both)
        large = both.join(star, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "edges")
        discard(star, current)
        lowest = _smallest(large)
        small = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = written(small.union(lowest.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "edges")
        discard(large, lowest)
    else:
        if exact and not _settled(current):
            raise RuntimeError(f"components are not settled after {most_rounds} rounds")
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return ends.union(roots).groupBy("node").agg(F.min("component").alias("component"))
