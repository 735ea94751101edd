"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.sources.scratch import materialize


def _are_stars(edges: DataFrame) -> bool:
    """Whether every upper end (a) has one edge and is no lower end (b) itself."""
    if not edges.groupBy("a").count().filter("count > 1").isEmpty():
        return False
    lower = edges.select(F.col("b").alias("a")).distinct()
    return edges.join(lower, "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is its component's least node.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): every node tells its
    neighbours of the least one it knows. The number of rounds grows with the logarithm of the
    longest path. Each round is written to the shared scratch folder, so lineage stays short and
    a lost executor costs one round. Minima are aggregated before the shuffle, and the joins
    are of the kind that adaptive execution splits for nodes with very many neighbours.
    """
    now = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(),
        "components",
    )
    while not _are_stars(now):
        # Large star: neighbours above a node go to the least node around it.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b").distinct()
        )
        large = materialize(large, "components")
        # Small star: a node and its neighbours below it go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
        now = materialize(small, "components")
    # Every node but the roots has one edge by now, to its root.
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
