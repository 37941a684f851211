"""Row filters: percentile trim, ranges, caps and their audit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.constants import NO_TRIM
from loadlens.operators.ranks import percentiles


def percentile_limit(df: DataFrame, value: str, percent: float, accuracy: int | None = None) -> float | None:
    """The threshold of a trim, or None where every row stays."""
    if percent >= NO_TRIM:
        return None
    if accuracy is None:
        return percentiles(df, value, [percent])[0]
    return df.agg(F.percentile_approx(value, percent / 100.0, accuracy)).first()[0]


def keep_below(df: DataFrame, value: str, limit: float | None) -> DataFrame:
    return df if limit is None else df.filter(F.col(value) < F.lit(limit))


def trim_above_percentile(
    df: DataFrame, value: str, percent: float, accuracy: int | None = None, of: DataFrame | None = None
) -> DataFrame:
    """Keep the rows strictly below a percentile; 100 and more keeps every row.

    The threshold is exact, unless ``accuracy`` asks for the one-pass sketch. It
    enters the plan as a literal, so the filter can reach the scan. It is
    searched in ``of``, if given: the same rows without the joins behind ``df``.
    """
    return keep_below(df, value, percentile_limit(df if of is None else of, value, percent, accuracy))


def in_range(c: str, at_least=None, above=None, below=None) -> Column:
    checks = []
    if at_least is not None:
        checks.append(F.col(c) >= at_least)
    if above is not None:
        checks.append(F.col(c) > above)
    if below is not None:
        checks.append(F.col(c) < below)
    condition = checks[0]
    for check in checks[1:]:
        condition = condition & check
    return condition


def keep_range(df: DataFrame, c: str, at_least=None, above=None, below=None) -> DataFrame:
    return df.filter(in_range(c, at_least, above, below))


def cap_below(df: DataFrame, value: str, cap: float) -> DataFrame:
    return df.filter(F.col(value) < cap)


def drop_key(df: DataFrame, c: str, unwanted: str) -> DataFrame:
    """Rows whose key differs from ``unwanted``."""
    return df.filter(F.col(c) != unwanted)


def audit(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: the number of rows, and of rows meeting each condition."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()])
