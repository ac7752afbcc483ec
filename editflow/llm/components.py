"""Connected components of a graph given by its edges, by alternating large and small stars (Kiveris et al., 2014).

Every step is an aggregation by minimum and an equi-join, so a vertex with very
many edges is pre-aggregated and never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import forget, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v.  Large: a vertex's greater neighbours go to its least; small: its lesser neighbours and itself do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (id, component) for every vertex of edges (columns u and v); component is the smallest id it reaches.

    Loops, repeated edges and edges with nulls may be there and change nothing.
    Rounds go on until one changes no edge; their number grows with the square
    of the logarithm of the vertices at most.
    """
    edges = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = settle(edges, "edges")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before, now = None, edges.agg(mark).first()[0]
    while now != before:
        last, edges = edges, settle(_star(_star(edges, True), False), "edges")
        forget(last)
        before, now = now, edges.agg(mark).first()[0]
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
