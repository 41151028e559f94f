"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.sources.sinks import staged


def components(edges: DataFrame, scratch: str) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b).

    Each round hangs a node's neighbours on its least one, first those above the node and
    then those below, so the rounds grow with the logarithm of the longest chain. Every
    round is written to ``scratch``, which cuts the lineage. A node's least neighbour is
    aggregated before the shuffle and joined back, so a node with very many edges is split
    by adaptive execution. Null ends and loops are ignored; no edges give no rows.
    """
    at = 0
    pairs = _downward(edges.select("a", "b"))
    pairs = staged(pairs, scratch, "edges-0")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        least = staged(least, scratch, f"least-{at}")
        above = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        above = staged(_downward(above), scratch, f"edges-{at + 1}")
        least = staged(above.groupBy("a").agg(F.min("b").alias("root")), scratch, f"least-{at + 1}")
        below = above.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        below = below.unionByName(least.select("a", F.col("root").alias("b")))
        at += 2
        pairs = staged(_downward(below), scratch, f"edges-{at}")
        before, mark = mark, _mark(pairs)
        if before == mark:
            break
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _downward(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _mark(pairs: DataFrame) -> tuple:
    """Of a set of edges: its size and an order-free hash."""
    return tuple(
        pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    )
