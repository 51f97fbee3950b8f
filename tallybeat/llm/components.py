"""Connected components of a distributed list of links.

Large-star and small-star steps turn any graph into stars around the smallest node of each
component in a number of rounds that grows with the logarithm of its size. A round is two
sums and two joins; a node with very many links is one row of the summed side, and its
links are split by adaptive skew handling on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallybeat.sources.tables import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v) with u > v: links to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = both.join(least, "u")
    if large:
        out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = met.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.filter(F.col("u") != F.col("v")).distinct()


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple[int, int]]:
    """The edges, staged, with their number and a hash that the writing job sums up."""
    mark = Observation()
    counts = (F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("hash"))
    edges = staged(edges.observe(mark, *counts), name)
    return edges, (mark.get["n"], mark.get["hash"])


def components(links: DataFrame) -> DataFrame:
    """(u, v) -> node, component (its smallest node); only nodes that have a link.

    Null ends and links of a node to itself are left out; repeated links count once.
    """
    edges, before = _written(
        links.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    while before[0]:
        edges, now = _written(_star(_star(edges, large=True), large=False), "stars")
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component), as ``components`` gives them, after further links (u, v).

    Only the components that the links touch are searched, not the links behind them.
    """
    own = labels.withColumnsRenamed({"node": "_node", "component": "_component"})
    ends = links
    for end in ("u", "v"):
        ends = ends.join(own, F.col(end) == F.col("_node"), "left").select(
            *[c if c != end else F.coalesce("_component", end).alias(end) for c in ("u", "v")]
        )
    joined = components(ends)
    moved = joined.withColumnsRenamed({"node": "_from", "component": "_to"})
    kept = labels.join(moved, F.col("component") == F.col("_from"), "left").select(
        "node", F.coalesce("_to", "component").alias("component")
    )
    return kept.unionByName(joined.join(labels.select("node"), "node", "left_anti"))
