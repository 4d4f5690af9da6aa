"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barsmith.llm.staging import drop_staged, staged


def _pointed(edges: DataFrame) -> DataFrame:
    """Every edge from its larger end ``a`` to its smaller end ``b``, once."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where("a <> b").distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, and none that is pointed
    to points on: then each star is a component."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")) \
        .unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    odd = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in")) \
        .agg(F.count_if((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))))
    return not odd.first()[0]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the
    smallest node that can be reached. Alternates two star operations until the
    edges are stars; each round's table is written to the shared folder, and a
    node's neighbours are only ever reduced to their minimum, never listed."""
    now = staged(_pointed(edges), "component-edges")
    while not _is_forest_of_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "component-least")
        # Every node's larger neighbours move to the least of its neighbourhood.
        large = staged(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")),
                       "component-large")
        lower = staged(large.groupBy("a").agg(F.min("b").alias("m")), "component-lower")
        # Every node and its smaller neighbours move to the least of these.
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(lower.select("a", F.col("m").alias("b")))
        after = staged(_pointed(small), "component-edges")
        for old in (now, least, large, lower):
            drop_staged(old)
        now = after
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
