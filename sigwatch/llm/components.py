"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """From (u, v) pairs: (node, component), component the smallest node that
    is reachable. Nodes without an edge are absent.

    A round points every node at its smallest neighbour (a partial aggregate,
    so a node with many edges is no hot spot), follows pointers, and replaces
    the edges by those between different targets. Every node that is not the
    smallest around it disappears, so few rounds are needed; each is a table
    in the shared folder."""
    edges = staged(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        to = staged(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                    .select("node", F.least("node", "m").alias("to")), "pointers")
        for _ in range(2):
            to = staged(_follow(to, to), "pointers")
        steps.append(to)
        edges = staged(
            edges.join(to.select(F.col("node").alias("u"), F.col("to").alias("a")), "u")
            .join(to.select(F.col("node").alias("v"), F.col("to").alias("b")), "v")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    if not steps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    label = steps[0]
    for to in steps[1:]:
        label = _follow(label, to)
    return staged(label.select("node", F.col("to").alias("component")), "components")


def _follow(label: DataFrame, to: DataFrame) -> DataFrame:
    """Each label moves on to where its target points (or stays)."""
    step = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
    return label.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
