"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), v < u. Large star: every larger neighbour of u is hung on the least of u's
    neighbourhood. Small star: u and its smaller neighbours are."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long ids, a < b, to (id, component_id): the smallest id that each id of an edge
    other than that smallest id itself reaches. Each round is written to the shared folder."""
    edges = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    before = None
    while True:
        edges = C.saved(_stars(_stars(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
        before = now
