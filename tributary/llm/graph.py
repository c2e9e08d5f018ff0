"""Connected components of an edge list, by alternating star operations on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node of the component.

    Each round links every node's larger neighbours to its smallest one, then its smaller ones too. Rounds are written
    to the shared folder, so that a lost executor costs one round at most; only a count and a checksum reach the driver.
    A hub's rows are aggregated on the map side and its join is left to Spark's splitting of skewed joins.
    """
    pairs = common.stored(edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "edges")
    state = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = common.stored(least.select("a", F.col("m").alias("b")).unionByName(small).distinct(), "edges")
        common.discard(pairs)
        pairs, before, state = new, state, _state(new)
        if state == before:
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a))")).first())
