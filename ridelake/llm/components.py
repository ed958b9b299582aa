"""Connected components of an edge table by alternating star contractions.

Each round hangs every node's larger neighbours on its smallest neighbour
(large star), then every node's smaller neighbours (small star); the edge
count never grows and the rounds grow with the logarithm of the component
size. Both steps are a partial aggregate and a join on narrow rows: AQE splits
the join partition of a hub node. Every round is a written table, so lineage
stays short and lost executors only repeat tasks of the current round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v, in; edges (v, smallest neighbour of u) out, without loops."""
    if large:
        ends = edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ends = edges
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = ends.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (two bigint columns, first and second):
    root is the smallest node of its component (roots have no row of their own).
    Loops, repeated edges and either direction are allowed; rows with a null are
    no edges; an empty edge table gives an empty result."""
    a, b = edges.columns
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNull().alias("x"), F.col(b).isNull().alias("y"))
                  .where("not x and not y and u <> v").select("u", "v").distinct(), "cc-edges")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(now)
    while seen[0]:
        now = written(_star(_star(now, True), False), "cc-edges")
        after = mark(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
