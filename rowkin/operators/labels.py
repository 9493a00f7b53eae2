"""Labels of linked nodes by alternating large-star and small-star steps, for the older rules' blocks of work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import dropped, heavy_keys, lookup, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: the greater ones, small: the smaller ones and itself) tied to its least one."""
    if large:
        edges = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    near = lookup(edges, "u", least, "w", "inner", heavy_keys(edges, "u", edges.count()))
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def linked_labels(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): every node of a pair and the least node it is linked with, directly or through others."""
    edges = written(pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "stars")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(edges)
    while before[0]:
        wide = written(_star(edges, True), "stars")
        new = written(_star(wide, False), "stars")
        dropped(wide)
        dropped(edges)
        edges, now = new, mark(new)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())
