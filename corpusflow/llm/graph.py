"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.store import looked_up, summed


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(looked_up(low, 2 * n), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame, n: int) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array("u", "v")).alias("a")
    return down.join(looked_up(low, 2 * n), "u").select(ends, F.col("m").alias("b"))


def _done(e: DataFrame) -> bool:
    """Is every node below one other and none below a third?"""
    ends = e.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty()


def stars(edges: DataFrame, n: int) -> tuple[DataFrame, int]:
    """``node`` and ``component`` (its smallest node) of the nodes of the ``n`` undirected
    edges ``a``, ``b`` (longs, a stored table), but for those smallest nodes themselves;
    stored, with their number."""
    e = edges.filter("a <> b")
    while True:
        e, (n,) = summed(_small_star(_large_star(e, n).filter("a <> b"), n).filter("a <> b").distinct(), "edges")
        if not n or _done(e):       # else the next pass has a row for each edge at most
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")), n


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` of every node of the edges, the smallest ones too.
    Nodes without an edge don't occur."""
    e = stars(edges, edges.count())[0].select(F.col("node").alias("a"), F.col("component").alias("b"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
