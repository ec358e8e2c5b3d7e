"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node with an edge to another; the root is its component's smallest node.

    Null ends, loops and repeated edges count for nothing.  Every step is a grouped minimum and a join, so no
    neighbourhood is gathered; each round is checkpointed in the shared folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo and " + f"{a} is not null and {b} is not null")
    e = e.distinct().checkpoint()
    mark = None
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(
            F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x")).select("x.hi", "x.lo").where("hi > lo").distinct()
        e = small.checkpoint()
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
