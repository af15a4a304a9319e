"""Connected components of a large graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of the edges (a, b); root is the component's smallest vertex.

    Each round every vertex turns to its smallest neighbour (itself included), the turns are followed to their
    end by pointer jumping, and the graph shrinks to the vertices turned to. Every round at least halves what a
    component has beyond two vertices, and all state lies in written tables.
    """
    edges = stored(edges.where("a <> b").select("a", "b"), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        turns = both.groupBy("a").agg(F.min("b").alias("b"))
        turns = stored(turns.select(F.col("a").alias("vertex"), F.least("a", "b").alias("root")), "turns")
        turns = _followed(turns)
        roots = stored(turns if roots is None else _composed(roots, turns), "roots")
        ends = {c: turns.select(F.col("vertex").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab"}
        moved = edges.join(ends["a"], "a").join(ends["b"], "b").where("a_root <> b_root")
        moved = moved.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
        edges = stored(moved.distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))


def _followed(turns: DataFrame) -> DataFrame:
    """Every vertex with the end of its chain of turns."""
    while True:
        jumped = stored(_composed(turns, turns, "was"), "turns")
        if jumped.where("root <> was").isEmpty():
            return jumped.drop("was")
        turns = jumped.drop("was")


def _composed(first: DataFrame, then: DataFrame, before: str | None = None) -> DataFrame:
    """The root of each root; ``before`` keeps the first one under that name."""
    step = then.select(F.col("vertex").alias("root"), F.col("root").alias("next"))
    joined = first.join(step, "root", "left")
    kept = [F.col("root").alias(before)] if before else []
    return joined.select("vertex", F.coalesce("next", "root").alias("root"), *kept)
