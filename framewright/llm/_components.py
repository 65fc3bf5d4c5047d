"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._shared import forget, stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b) that isn't itself the
    root; the root is a component's least node.  Each round is written to the
    shared folder, and the one before deleted.  Not ending within ``rounds``,
    some five times log2 of the longest path, is an error.  Hubs are joined with one row each, so a hub's edges can be
    split over tasks."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    mark = _mark(now)
    for _ in range(rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        before, now = now, stored(small, "components")
        forget(edges.sparkSession, before, large)
        if (new := _mark(now)) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
    raise RuntimeError(f"no end after {rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
