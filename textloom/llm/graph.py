"""Connected components by alternating large and small stars, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import drop_written, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge between two different nodes; label is the smallest node reachable."""
    now = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop_written(now)
        seen = new.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == tuple(seen) or seen[0] == 0:
            return new.select(F.col("u").alias("node"), F.col("v").alias("label")).union(new.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        mark, now = tuple(seen), new
