"""Distributed connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi join on node ids. The table of
minima is written before the join, so both join sides are plain exchanges and
AQE can split a node that holds a large share of all edges. The number of
edges never grows, and no edge or label reaches the driver: it reads one
fingerprint row of the edge set per round to see whether anything changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, drop_cut


def _state(edges: DataFrame) -> tuple:
    """Order-independent fingerprint of an edge set (one row)."""
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.abs(h) % 1000003)).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge with two different ends.

    ``component`` is the smallest node of the component in the order of the
    node type. Null ends, self loops, repeated and reversed edges are ignored.
    An empty edge table gives an empty result.
    """
    e = edges.select(F.col(a).alias("p"), F.col(b).alias("q")).filter("p != q")
    e = cut(e.select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v")).distinct(), "cc")
    state = _state(e)
    while state[0]:
        both = e.selectExpr("u as n", "v as m").union(e.selectExpr("v as n", "u as m"))
        low = cut(both.groupBy("n").agg(F.min("m").alias("lo")), "cc-low")
        large = cut(both.join(low, "n").filter("m > n")
                    .select(F.col("m").alias("u"), F.least("n", "lo").alias("v")).distinct(), "cc-large")
        low_small = cut(large.groupBy("u").agg(F.min("v").alias("lo")), "cc-low")
        new = cut(large.join(low_small, "u").filter("v != lo").selectExpr("v as u", "lo as v")
                  .union(low_small.selectExpr("u", "lo as v")).distinct(), "cc")
        before, state = state, _state(new)
        for old in (e, low, large, low_small):
            drop_cut(old)
        e = new
        if state == before:
            break
    return e.selectExpr("u as node", "v as component").union(
        e.selectExpr("v as node", "v as component").distinct())
