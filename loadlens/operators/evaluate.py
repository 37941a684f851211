"""Prediction quality as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.cleaning import present


def error_of(actual: Column | str, predicted: Column | str) -> Column:
    """Actual minus predicted; NULL where either is missing."""
    return present(actual) - present(predicted)


def rmse_of(actual: Column | str, predicted: Column | str) -> Column:
    """Root mean squared error as an aggregate expression, over the rows that have both values."""
    error = error_of(actual, predicted)
    return F.sqrt(F.avg(error * error))


def rmse(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """``n`` and ``rmse``, over all rows or per group; ``n`` counts the rows that enter."""
    return df.groupBy(*(by or [])).agg(F.count(error_of(actual, predicted)).alias("n"), rmse_of(actual, predicted).alias("rmse"))


def baseline_rmse(df: DataFrame, actual: str, constant: float | None = None) -> DataFrame:
    """Error of predicting one number everywhere; by default the mean. Missing values do not count."""
    df = df.select(present(actual).alias(actual))
    error = F.stddev_pop(actual) if constant is None else rmse_of(actual, F.lit(constant))
    return df.agg(F.count(actual).alias("n"), F.avg(actual).alias("mean"), error.alias("rmse"))


def shifted(df: DataFrame, prediction: str, by: float) -> DataFrame:
    return df.withColumn(prediction, F.col(prediction) + F.lit(by))


def pooled_rmse(frames: list[DataFrame], actual: str, predicted: str) -> DataFrame:
    """Error over the rows of all frames, not the mean of their errors."""
    pooled = frames[0].select(actual, predicted)
    for frame in frames[1:]:
        pooled = pooled.unionByName(frame.select(actual, predicted))
    return rmse(pooled, actual, predicted)
