"""Connected components of an edge table, by alternating large and small
stars until the edges stay the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import drop_written, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every vertex hands its larger neighbours to the smallest
    vertex it knows.  Small star: it hands over its smaller ones, and itself."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges  # u > v
    least = near.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
    both = near.join(least, "u")
    if large:
        out = both.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        out = both.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(
            least.select("u", F.col("_m").alias("v")))
    return out.where("u != v").select(F.greatest("u", "v").alias("u"),
                                      F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest vertex reachable) for every vertex
    that has an edge and is not itself the smallest."""
    def state(df):
        r = df.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    now = written(edges.where(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = state(now)
    while seen[0]:
        after = written(_star(_star(now, True), False), "edges")
        drop_written(now)
        now, before, seen = after, seen, state(after)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
