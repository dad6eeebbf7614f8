"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingotflow.llm.common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every id in the columns ``a, b``: the smallest id it reaches.

    Alternating star contraction: every node hands its larger neighbours to its smallest one, then the
    smaller ones, until the edges are stars. Rounds grow with the logarithm of the longest path, and an
    edge never becomes two, so a hub with many links stays as large as its own links. Each round is
    written to the shared folder and the one before deleted; the driver only reads whether it changed anything.
    """
    spark = links.sparkSession
    edges, path = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (edges.select(F.col("b").alias("n"), F.col("a").alias("far"))
                 .join(lowest, F.col("n") == F.col("a")).where("far <> low")
                 .select(F.col("far").alias("a"), F.col("low").alias("b"))
                 .union(lowest.where("a <> low").select("a", F.col("low").alias("b"))).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(low.select("a", F.col("low").alias("b"))).distinct())
        (edges, path), last = stored(small, "edges"), path
        discard(spark, last)
        # stars only, once no lower end is itself below another, and nothing moved
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == before:
            break
        before = state
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select("b", "b").distinct()))
