"""Connected components of a link table, as repeated joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.session import stage


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``: root is the smallest node that links lead to.

    Alternates the large-star and small-star steps: each node passes the least of its neighbours on to the
    others, until nothing changes.  Minima combine before the shuffle; a hub's rows are dealt by the join, which
    AQE splits.  Each round is written to the shared folder.  An empty table gives an empty table; loops and
    repeated links do no harm.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stage(edges, "links")
    seen = _digest(edges)
    if not seen[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = stage(small.select("e.*").where("a <> b").distinct(), "links")
        now = _digest(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
