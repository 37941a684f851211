"""Summary of every column as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.constants import NULL_TEXT
from loadlens.functions.cleaning import present


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: counts, distinct values, range, moments, top value.

    Values are counted per column first (map-side combined), so neither a column
    with one dominant value nor one with only distinct values meets in one task
    before it has been reduced.
    """
    columns = list(columns or df.columns)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = text.unpivot([], columns, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
    n, x = F.col("n"), present(F.col("value").try_cast("double"))
    # Most frequent value, the alphabetically first one on a tie.
    top = F.min(F.when(F.col("value").isNotNull(), F.struct((-n).alias("n"), F.col("value").alias("value"))))
    summary = counted.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value") == NULL_TEXT, n)), F.lit(0)).alias("n_null_text"),
        F.count("value").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        top.alias("top"),
        F.sum(F.when(x.isNotNull(), n)).alias("_numbers"),
        F.sum(n * x).alias("_sum"),
    )
    # Deviations from the known mean, so that large values do not cancel out.
    # The lookup has one row per column of the input.
    means = summary.select("column", (F.col("_sum") / F.col("_numbers")).alias("mean"))
    squares = (
        counted.join(F.broadcast(means), "column")
        .groupBy("column")
        .agg(F.first("mean").alias("mean"), F.sum(n * (x - F.col("mean")) * (x - F.col("mean"))).alias("_squares"))
    )
    return summary.join(F.broadcast(squares), "column").select(
        "column",
        "n_rows",
        "n_null_text",
        "n_distinct",
        "min_value",
        "max_value",
        F.col("top.value").alias("top_value"),
        (-F.col("top.n")).alias("top_count"),
        "mean",
        F.sqrt(F.col("_squares") / F.col("_numbers")).alias("std"),
    )


# Sketch sizes of ``sketch_profile``: registers of a distinct count as a power of two, items tracked for the top value.
DISTINCT_LOG, TOP_ITEMS = 14, 10_000
#: Three standard errors of a distinct count with so many registers.
DISTINCT_BOUND = 3 * 1.04 / 2 ** (DISTINCT_LOG / 2)
#: Most by which the count of a top value can be off, as a share of the rows.
TOP_BOUND = 3.5 / TOP_ITEMS
#: Most by which the rank of a quantile is off in 99 of 100 cases, as a share of the rows.
QUANTILE_SKETCH, QUANTILE_BOUND = 400, 0.01


def sketch_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_profile`` from one aggregate over the rows, with sketches where values would have to travel.

    Counts, range, mean and deviation are exact. ``n_distinct`` is off by at
    most ``DISTINCT_BOUND`` of it in 997 of 1,000 cases, ``top_count`` by at most
    ``TOP_BOUND`` of the rows, and the quartiles ``q25``, ``median``, ``q75`` of
    the numbers lie within ``QUANTILE_BOUND`` of their rank. Only sketches of
    bounded size are shuffled, one set per task, however many values there are.
    """
    columns = list(columns or df.columns)
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])

    def summary(i: int) -> Column:
        v = F.col(f"c{i}")
        x = present(v.try_cast("double"))
        finite = F.when(F.abs(x) < float("inf"), x)
        return F.struct(
            F.count("*").alias("n_rows"),
            F.count_if(v == NULL_TEXT).alias("n_null_text"),
            F.hll_sketch_estimate(F.hll_sketch_agg(v, DISTINCT_LOG)).alias("n_distinct"),
            F.min(v).alias("min_value"),
            F.max(v).alias("max_value"),
            F.get(F.expr(f"approx_top_k(c{i}, 5, {TOP_ITEMS})"), F.lit(0)).alias("top"),
            F.avg(finite).alias("mean"),
            F.stddev_pop(finite).alias("std"),
            F.when(F.count(finite) > 0, F.kll_sketch_agg_double(finite, QUANTILE_SKETCH)).alias("sketch"),
        ).alias(f"s{i}")

    one = text.agg(*[summary(i) for i in range(len(columns))])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("s")) for i, c in enumerate(columns)])).alias("r"))
    at = lambda q: F.when(F.col("s.sketch").isNotNull(), F.kll_sketch_get_quantile_double("s.sketch", F.lit(q)))
    return rows.select("r.*").select(
        "column",
        *[F.col(f"s.{c}") for c in ("n_rows", "n_null_text", "n_distinct", "min_value", "max_value")],
        F.col("s.top.item").alias("top_value"),
        F.col("s.top.count").alias("top_count"),
        "s.mean",
        "s.std",
        at(0.25).alias("q25"),
        at(0.5).alias("median"),
        at(0.75).alias("q75"),
    )
