"""Connected components of a graph given as pairs, by alternating stars.

Each round hangs the larger neighbours of every node on its least neighbour
(large star), then the smaller ones (small star), until only stars are left;
rounds grow with the logarithm of the longest chain. A node's neighbours are
pre-aggregated to their minimum, never gathered. The edges of each round are a
table in the shared folder; a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martlet.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u < v."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    arcs = edges.unionByName(flipped) if large else flipped
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("m", "u").alias("m"))
    met = arcs.join(least, F.col("u") == F.col("n"))
    if large:
        out = met.filter(F.col("v") > F.col("u")).select(F.col("m").alias("u"), "v")
    else:
        out = met.select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("n").alias("v")))
    return out.filter("u < v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(pairs: DataFrame) -> DataFrame:
    """(node, label): every node of ``pairs`` (u, v) with its component's least
    node. Nodes without a pair do not occur."""
    edges = cut_lineage(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v"), "links")
    state = None
    while (now := _state(edges)) != state:
        state = now
        edges = cut_lineage(_star(_star(edges, True), False), "stars")
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("label")))
