"""Connected components of links, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opdiag.operators.sized import join_lookup
from opdiag.session import shared_dir


def _ordered(frame: DataFrame) -> DataFrame:
    """Distinct links with the greater node first, without those of a node with itself."""
    return (
        frame.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(frame: DataFrame) -> tuple:
    return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the component's least node.

    Alternates two steps until nothing changes: every node points its larger neighbours, then its
    smaller ones, at the least node it sees, so that paths shorten and each component ends as a
    star around its least node. The number of rounds grows with the logarithm of the longest path.
    A node's neighbours are only ever reduced to their minimum, never gathered; each round is
    written to the checkpoint folder. Null nodes and links of a node with itself are left out.
    """
    shared_dir(links.sparkSession)
    edges = _ordered(links.select("a", "b")).checkpoint()
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = least.select("a", F.least("a", "low").alias("low"))
        large = _ordered(
            join_lookup(both.filter("b > a"), least, ["a"])
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = join_lookup(large, lowest, ["a"]).select(
            F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("low").alias("b")
        )
        edges = _ordered(small).checkpoint()
        following = _state(edges)
        if following == state:
            break
        state = following
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
