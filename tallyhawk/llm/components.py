"""Connected components of a link table by alternating star contractions.

Each round links every vertex's larger neighbours, then its smaller ones, to the smallest it knows, which keeps
components as they are and ends in stars. Minima are aggregated before they are shuffled, so a vertex with very many
links costs no task more than its share of rows. Every round is written out; only a flag and a sum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhawk.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """From (a, b) with a > b."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
    near = both.filter("u > v") if large else both.unionByName(both.select("v", F.col("v").alias("u")).distinct())
    moved = near.join(least, "v").filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def components(links: DataFrame) -> DataFrame:
    """(doc, comp) for every vertex of ``links`` (x, y); ``comp`` is the smallest vertex reachable."""
    edges = links.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    edges = cut_lineage(edges)
    state = None
    while True:
        edges = cut_lineage(_star(_star(edges, True), False))
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return edges.select(F.col("a").alias("doc"), F.col("b").alias("comp"))
