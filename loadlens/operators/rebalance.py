"""Replicate rows of rare target values up to a wanted count per bin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.constants import BIN_WIDTH, REBALANCE_TARGET, REBALANCE_WHOLE_BINS
from loadlens.functions.bins import interval, nearest_edge
from loadlens.operators.histogram import edges_for
from loadlens.operators.ranks import SMALL_GROUP, cutoffs
from loadlens.session import as_lookup, cut_lineage


def bin_plan(
    df: DataFrame, value: str, width: float, edges: int, target: int, whole_bins: int, mode: str
) -> DataFrame:
    """Per bin: its row count, how often to repeat it, and how many rows once more.

    ``clean`` counts the rows nearest to the edge. ``compat`` measures a bin by
    its histogram interval but copies the rows nearest to its edge, takes one row
    more than the remainder, and leaves out the last edge.
    """
    placed = (
        df.select(nearest_edge(F.col(value), width, edges).alias("bin"), interval(F.col(value), width, edges).alias("_in"))
        .filter("bin is not null")
        .groupBy("bin", "_in")
        .agg(F.count("*").alias("_n"))
    )
    placed = cut_lineage(placed)
    sizes = placed.groupBy("bin").agg(F.sum("_n").alias("_size"))
    if mode == "clean":
        measured = sizes.withColumn("_measure", F.col("_size"))
        keep, more = F.lit(True), 0
    elif mode == "compat":
        inside = placed.filter("_in is not null").groupBy(F.col("_in").alias("bin")).agg(F.sum("_n").alias("_measure"))
        measured = sizes.join(inside, "bin", "left").withColumn("_measure", F.coalesce("_measure", F.lit(0)))
        keep, more = (F.col("bin") < whole_bins) | (F.col("bin") < edges - 1), 1
    else:
        raise ValueError(f"unknown mode {mode!r}")
    n, t = F.col("_measure"), F.lit(target)
    repeat = (
        F.when(F.col("bin") < whole_bins, 1).when(~keep, 0).when(n > t, 1).when(n == 0, 0).otherwise(F.floor(t / n))
    )
    partial = keep & (F.col("bin") >= whole_bins) & (n > 0) & (n <= t) & (t % F.greatest(n, F.lit(1)) > 0)
    extra = F.when(partial, t % F.greatest(n, F.lit(1)) + more).otherwise(0)
    return measured.select("bin", "_size", repeat.cast("int").alias("_repeat"), extra.cast("bigint").alias("_take"))


def rebalance(
    df: DataFrame,
    value: str,
    order: str,
    width: float = BIN_WIDTH,
    target: int = REBALANCE_TARGET,
    whole_bins: int = REBALANCE_WHOLE_BINS,
    mode: str = "compat",
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Rows of ``df`` repeated per the plan, with their ``bin``.

    Which rows are repeated once more is decided by the order value of the last
    of them, so no bin is sorted as a whole unless it is known to be small. Rows
    without a value belong to no bin and are left out.
    """
    edges = edges_for(df, value, width)
    plan = cut_lineage(bin_plan(df, value, width, edges, target, whole_bins, mode))
    binned = df.withColumn("bin", nearest_edge(F.col(value), width, edges))
    limits = cutoffs(binned, ["bin"], order, plan.filter("_take > 0"), small)
    steps = as_lookup(plan.join(limits, "bin", "left").select("bin", "_repeat", "_cut"))
    times = F.col("_repeat") + F.when(F.col(order) <= F.col("_cut"), 1).otherwise(0)
    most = plan.agg(F.max(F.col("_repeat"))).first()[0] or 0
    return copied(binned.join(steps, "bin"), times.cast("bigint"), order, most + 1).select(*df.columns, "bin")


#: Copies that one array holds; a row with more is copied block by block, in several tasks.
COPY_BLOCK = 1_000


def copied(df: DataFrame, times: Column, order: str, most: int) -> DataFrame:
    """Every row ``times`` over (not at all for 0); ``most`` bounds the number.

    Beyond ``COPY_BLOCK`` the row first becomes one row per block of copies, and
    these are dealt out by key and block, so that a few rows with very many
    copies end neither in one task nor in one array.
    """
    rows = df.withColumn("_times", times).filter("_times > 0")
    if most > COPY_BLOCK:
        blocks = F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / COPY_BLOCK).cast("int"))
        rows = rows.withColumn("_block", F.explode(blocks)).repartition(order, "_block")
        rows = rows.withColumn("_times", F.least(F.lit(COPY_BLOCK), F.col("_times") - F.col("_block") * COPY_BLOCK)).drop("_block")
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int")))).drop("_copy", "_times")
