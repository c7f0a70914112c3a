"""Connected components of an edge table by repeated contraction, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b): root is the least node of its component.

    Each round gives every node its least neighbour (or itself) as parent, follows parents twice, and
    replaces edges by those between parents; edges within one parent vanish. Rounds are written out, so lineage
    stays short. Empty edges give an empty table.
    """
    edges = scratch.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges0")
    roots, turn = None, 0
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root"))
        parents = scratch.cut(parents, f"{label}-parents{turn}")
        step = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = parents.join(step, "root").select("node", F.col("next").alias("root"))
        jumped = scratch.cut(jumped.join(step, "root").select("node", F.col("next").alias("root")), f"{label}-jumped{turn}")
        moved = edges.join(jumped.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        moved = moved.join(jumped.select(F.col("node").alias("b"), F.col("root").alias("y")), "b").where("x <> y")
        edges = scratch.cut(moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), f"{label}-edges{turn + 1}")
        if roots is None:
            roots = jumped
        else:
            onward = jumped.select(F.col("node").alias("root"), F.col("root").alias("next"))
            joined = roots.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            roots = scratch.cut(joined, f"{label}-roots{turn}")
        turn += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
