"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.storage import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and hash sum of the links: equal before and after a round only if nothing changed."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least node it sees."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "n")
    return both.join(least, F.col("a") == F.col("n")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them (links point from ``a`` down to ``b``)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    tied = edges.join(least, F.col("a") == F.col("n")).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't the least of its component; ``root`` is the least.

    The links stay distributed; each round is written to the shared folder, and rounds grow with the
    logarithm of the longest chain.
    """
    down = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(down, "links")
    mark = _mark(now)
    while True:
        now = stored(_small_star(_large_star(now)), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
