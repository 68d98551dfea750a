"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every end of a link (a, b): the least id that links reach.

    Each round hangs the neighbours of a node below its least neighbour, so long chains
    halve. Rounds are written to the shared folder; only a count and a checksum come to
    the driver. Loops and repeated links change nothing.
    """
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(ends.where("a < b").distinct(), "edges")
    mark = None
    while True:
        sign = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(sign) == mark or not sign[0]:
            break
        mark = tuple(sign)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.least("m", "u").alias("a"), F.col("v").alias("b"))
            .distinct()
        )
        below = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(below, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")
        )
        small = small.union(below.select(F.col("m").alias("a"), "b"))
        edges = stored(small.where("a < b").distinct(), "edges")
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).union(roots)
