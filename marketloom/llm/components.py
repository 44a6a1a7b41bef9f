"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.sources.tables import write_scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of the component.

    ``edges`` has two columns of one type; nodes without an edge do not appear.
    Every round is written to the shared folder, so lineage stays short; the
    number of rounds grows with the logarithm of the longest path."""
    a, b = edges.columns
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    now = write_scratch(now.distinct(), "edges")
    before, state = None, _state(now)
    while state != before:
        before = state
        stars = write_scratch(_large_star(now).filter("u <> v").distinct(), "edges")
        now = write_scratch(_small_star(stars).filter("u <> v").distinct(), "edges")
        state = _state(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
