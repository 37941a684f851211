"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import unsent, write_table


def _minimum(pairs: DataFrame) -> DataFrame:
    """(a, b) with the smallest of a and its b's as ``m``."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return pairs.join(unsent(least), "a")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) can reach.

    Alternates two steps until nothing changes: hang larger neighbours on the
    smallest neighbour, then smaller ones. No step gathers the neighbours of a
    node in one place: the minimum combines map-side and is joined back. Each
    round is stored, so a lost executor repeats one round at most.
    """
    a, b = F.col("a"), F.col("b")
    now = write_table(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(a != b).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        large = _minimum(both).where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        small = _minimum(large.distinct())
        star = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        now = write_table(star.where(a != b).distinct(), "edges")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(a.alias("node"), b.alias("root")).unionByName(now.select(b.alias("node"), b.alias("root"))).distinct()
