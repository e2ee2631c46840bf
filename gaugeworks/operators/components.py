"""Connected components of a graph of any size, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.sources.shared import written


def components(edges: DataFrame) -> DataFrame:
    """node and root (the component's smallest node) of all ends of the edges (a, b), loops included.

    In each round every node points to its smallest neighbour, if smaller, and pointers are doubled until all end at nodes that point nowhere. What is left are edges
    between these. Of two neighbours the larger one always goes, and a path goes in one round. No neighbours are gathered.
    """
    edges = written(edges.select("a", "b").distinct(), "edges")
    out = None
    while True:
        both = edges.union(edges.select("b", "a"))
        step = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "pointers")
        moved = True
        while moved:
            doubled = written(_through(step, step).withColumn("moved", F.col("to") != F.col("root")), "pointers")
            moved = not doubled.filter("moved").isEmpty()
            step = doubled.select("node", F.col("to").alias("root"))
        out = step if out is None else written(_through(out, step).select("node", F.col("to").alias("root")), "roots")
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        edges = written(ends.filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return out


def _through(roots: DataFrame, step: DataFrame) -> DataFrame:
    """roots, with where the step sends each on `to`."""
    there = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return roots.join(there, "root", "left").select("node", "root", F.coalesce("next", "root").alias("to"))
