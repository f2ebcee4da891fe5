"""Distributed connected components by repeated contraction.

Every node hooks onto its smallest neighbour if that is smaller than itself,
pointers are jumped, and the edges are renamed to what their ends hook onto;
edges inside a component vanish.  A star is done in one round, a long chain
in a number of rounds that grows with the logarithm of its length.  All steps
are joins and partial aggregates on Spark; a node with very many edges is a
skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_empty, materialize


def _jump(pointers: DataFrame) -> DataFrame:
    """``to`` replaced by what it points to itself."""
    nxt = pointers.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
    return pointers.join(nxt, "to", "left").select("node", F.coalesce("beyond", "to").alias("to"))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node with an edge; comp is the smallest node reachable.

    ``edges`` has two columns of one orderable type, without nulls; direction,
    repeats and loops don't matter.
    """
    a, b = edges.columns
    kind = edges.schema[a].dataType
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    ends = materialize(ends.union(ends.select("b", "a")).distinct(), "edges")
    found = None
    while not is_empty(ends):
        hooks = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        hooks = materialize(_jump(materialize(hooks, "hooks")), "hooks")
        left, right = (hooks.select(F.col("node").alias(x), F.col("to").alias(y)) for x, y in (("a", "u"), ("b", "v")))
        ends = materialize(ends.join(left, "a").join(right, "b").where("u <> v")
                           .select(F.col("u").alias("a"), F.col("v").alias("b")).distinct(), "edges")
        if found is None:
            found = hooks.select("node", F.col("to").alias("comp"))
        else:
            found = materialize(found.join(hooks.withColumnsRenamed({"node": "comp", "to": "next"}), "comp", "left")
                                .select("node", F.coalesce("next", "comp").alias("comp")), "found")
    if found is None:
        return edges.sparkSession.createDataFrame([], "node long, comp long").select(
            F.col("node").cast(kind).alias("node"), F.col("comp").cast(kind).alias("comp"))
    return found
