"""Connected components of links between documents, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def _hang(links: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours (all, or the larger ones alone) tied to the smallest of the node and its neighbours."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = links.join(least, "u")
    if larger_only:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    both = tied.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
    return both.select("x.u", "x.v")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that a link touches; a component is named by its smallest node.

    Alternates the two star operations of the large-star/small-star method until the links stop changing. A
    node's neighbours are never gathered: minima are combined map-side, and a hub is a join key that adaptive
    execution splits. Each round is fixed by a reliable checkpoint.
    """
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    mark = None
    while True:
        ways = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(ways, larger_only=True).where("u != v").distinct()
        now = checkpointed(_hang(large, larger_only=False).where("u != v").distinct())
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark or not new[0]:
            break
        mark = new
    heads = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionAll(heads).select(F.col("u").alias("node"), F.col("v").alias("component"))
