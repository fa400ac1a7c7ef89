"""Connected components as rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import drop_scratch, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (u, v: long) reaches.

    Large-star and small-star steps in turn, each a grouped minimum and a join: in the end every node hangs on the
    smallest of its component. The number of rounds grows with the logarithm of a component's size. A node with very
    many edges is a skewed join key, which adaptive execution splits; its minimum is combined before the shuffle.
    Rounds are written to the shared folder. Null ends and loops are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    now, path = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        after, where = stored(small, "edges")
        drop_scratch(spark, path)
        now, path = after, where
        was, mark = mark, _mark(now)
        if was == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
