"""Connected components by alternating large-star and small-star steps; nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialised


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: every node of ``edges`` (two long columns) with the smallest node that it reaches.

    The number of rounds grows with the logarithm of the number of nodes. Loops, repeated edges and nulls are ignored.
    """
    stars = materialised(_directed(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))))
    before = None
    while (now := _mark(stars)) != before:
        before = now
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = _directed(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        stars = materialised(_directed(small.select("e.a", "e.b")))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return (
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]
