"""Fast and slow segments by the median of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.constants import SEGMENT_KEYS, SLOW_MEDIAN
from loadlens.operators.ranks import SMALL_GROUP, group_quantile, join_on
from loadlens.session import as_lookup


def slow_groups(
    df: DataFrame, value: str, keys: list[str] = SEGMENT_KEYS, above: float = SLOW_MEDIAN, small: int = SMALL_GROUP
) -> DataFrame:
    """Keys of the groups whose median exceeds a threshold."""
    return group_quantile(df, keys, value, 0.5, small).filter(F.col("_quantile") > above).select(*keys)


def rows_in(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is among the groups; a NULL key is a group like any other."""
    return join_on(df, as_lookup(groups.select(*keys)), keys, "left_semi")


def rows_not_in(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """The other rows; together with ``rows_in`` every row comes out once."""
    return join_on(df, as_lookup(groups.select(*keys)), keys, "left_anti")


def flag_rows(df: DataFrame, groups: DataFrame, keys: list[str], flag: str = "is_slow") -> DataFrame:
    """Add a membership flag with one join, for uses that need both segments.

    ``groups`` holds each key once.
    """
    marked = groups.select(*keys).withColumn("_member", F.lit(True))
    return join_on(df, as_lookup(marked), keys, "left").withColumn(flag, F.col("_member").isNotNull()).drop("_member")


def split_by_flag(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and with the flag; a missing flag is no flag."""
    marked = F.col(flag).eqNullSafe(True)
    return df.filter(~marked), df.filter(marked)
