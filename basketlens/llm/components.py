"""Distributed union-find: connected components of an edge table.

Alternating large-star and small-star rounds over plain aggregations and
joins; ids can be of any orderable type. No group is gathered: a hub's
smallest neighbour is a partial aggregate, and the join that hands it out has
a shuffle on both sides, so AQE can split a hub's rows over tasks. Each round
is written to the shared folder, and the one before it removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import drop, stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _star(edges: DataFrame) -> DataFrame:
    """Hand every u's smallest v to its rows: columns u, v, m."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(low, "u")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component)`` for each id on an edge; component is the smallest
    id reachable. Self-loops, repeated and null edges add nothing; an empty
    edge table gives an empty result."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where((F.col(a) != F.col(b))).distinct())
    e = stage(e, "edges")
    before = _signature(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_star(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        small = (_star(large)
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        last, e = e, stage(small, "edges")
        drop(last)
        after = _signature(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def extended_components(label: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """``label`` (a result of ``connected_components``) after further edges:
    edges inside a component are dropped, the others link its smallest id, so
    the rounds run over what is new alone."""
    x, y = (label.select(F.col("id").alias(c), F.col("component").alias(f"{c}_component")) for c in (a, b))
    across = (edges.select(a, b).join(x, a, "left").join(y, b, "left")
              .select(F.coalesce(f"{a}_component", a).alias("x"), F.coalesce(f"{b}_component", b).alias("y")))
    over = connected_components(across, "x", "y")
    moved = (label.join(over.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
             .select("id", F.coalesce("to", "component").alias("component")))
    return moved.unionByName(over.join(label.select("id"), "id", "left_anti").select("id", "component"))
