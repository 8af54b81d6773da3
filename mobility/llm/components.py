"""Connected components of a link table by alternating large and small stars.

Every round is two joins of the links with each node's least neighbour, so no
task or driver ever holds the graph. A hub is pre-aggregated by the partial
``min`` and split by the adaptive skew join. Each round is a reliable
checkpoint in the session's checkpoint folder; rounds grow with the logarithm
of the longest path.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.session import shared_root


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One star round on links (a, b), a > b.

    large: every greater neighbour of a node moves to the node's least one.
    small: the node and its lesser neighbours move to the least of them.
    """
    if large:
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")).toDF("a", "b"))
    else:
        both = links.select("a", "b")
    least = (both.groupBy("a").agg(F.min("b").alias("m"))
             .select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
    joined = both.join(least, both["a"] == least["n"])
    if large:
        moved = joined.where(F.col("b") > F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))))
    return moved.where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)`` (long);
    ``component`` is the least node reachable. Nodes without links don't
    appear; loops, repeats and links with a null end have no effect."""
    shared_root(links.sparkSession)  # names the checkpoint folder where none is set
    edges = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
             .checkpoint())
    state = None
    while True:
        edges = _stars(_stars(edges, large=True), large=False).checkpoint()
        seen = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"),
                         F.expr("bit_xor(xxhash64(b, a, 7))")).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select("b", "b").distinct().toDF("node", "component")))
