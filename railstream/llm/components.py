"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream.llm.store import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); a component is its smallest node.

    Alternates two steps until nothing changes: every node's larger neighbours are hung under its
    smallest one, then all its smaller ones are. The number of rounds grows with the logarithm of
    the longest path. Smallest neighbours are found by partial aggregates, and the joins back to
    the edges may be split at run time, so a node with very many edges is no single task. Each
    round is a stored table; only a count and a checksum reach the driver. A graph without edges
    has no rows.
    """
    pairs = edges.filter("a <> b")
    now = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = stored(both.filter("v > u").join(least, "u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
                 .unionByName(least).select("u", F.col("m").alias("v")).distinct())
        now = stored(small, "small-star")
        last, state = state, _state(now)
        if state == last:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
