"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from milepost.operators.skew import one_per_key
from milepost.session import cut_lineage


def _mark(edges: DataFrame) -> tuple:
    """Number and hash of the edges, to see whether a round changed them."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = one_per_key(both, ["a"], F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.filter("b > a").join(least, "a").filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them; ``b < a`` in all rows."""
    least = one_per_key(edges, ["a"], F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node that has a link.

    ``links`` has two columns of one orderable type. Rounds of large and small stars replace the
    edges until they no longer change; their number grows with the logarithm of the graph. Each
    round is written to the shared folder, so nothing is computed twice and lost executors cost one
    round at most. Minima are taken by partial aggregates, and joins on a node with very many links
    are split. Links of a node to itself and repeated links are allowed; no links give no rows.
    """
    x, y = links.columns
    pair = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter("a <> b")
    edges = cut_lineage(pair.distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = cut_lineage(_small_star(_large_star(edges)), "stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
