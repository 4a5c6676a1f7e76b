"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.session import drop_staged, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component (the smallest node reachable) of every node with an edge.

    Nodes are longs; loops and edges with a null end are ignored. Each round writes its
    edges to the shared folder; only two numbers a round reach the driver.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return row["n"], row["x"]

    now = materialize(pairs, "components")
    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        last, now = now, materialize(small, "components")
        drop_staged(last)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
