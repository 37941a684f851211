"""Group statistics and label numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.cleaning import filled, present
from loadlens.operators.ranks import SMALL_GROUP, grouped_quantile
from loadlens.session import cut_lineage, measured


def group_spread(
    df: DataFrame, keys: list[str], value: str, ddof: int = 0, approximate: bool = False, small: int = SMALL_GROUP, many: bool = False
) -> DataFrame:
    """Row count, mean, median and standard deviation of ``value`` per group.

    The median is exact. ``approximate=True`` uses the built-in sketch instead,
    one pass and mergeable, for exploration of very large logs. NaN counts as
    missing; a group without any value has n = 0 and NULL statistics; a NULL key
    is a group. ``many`` is for keys with many groups, most of them short.
    """
    df = df.withColumn(value, present(value))
    deviation = F.stddev_samp(value) if ddof else F.stddev_pop(value)
    plain = [F.count(value).alias("n"), F.avg(value).alias("mean"), deviation.alias("std")]
    if approximate:
        return df.groupBy(*keys).agg(*plain, F.percentile_approx(value, 0.5, 10_000).alias("median"))
    found = grouped_quantile(df, keys, value, 0.5, plain, small, many=many)
    return found.select(*keys, "n", "mean", "std", F.col("_quantile").alias("median"))


def group_means(df: DataFrame, features: list[str], value: str) -> DataFrame:
    """Mean of ``value`` per level of each feature, all features in one pass.

    Missing values are not counted; a level without any has n = 0 and no mean.
    """
    return (
        df.select(present(value).alias(value), *[F.col(f).cast("string") for f in features])
        .unpivot([value], features, "feature", "level")
        .groupBy("feature", "level")
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    )


def label_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per label of each column: ``feature``, ``label``, ``n``."""
    return (
        df.select(*[F.col(c).cast("string") for c in columns])
        .unpivot([], columns, "feature", "label")
        .groupBy("feature", "label")
        .agg(F.count("*").alias("n"))
    )


def number_labels(counts: DataFrame) -> DataFrame:
    """Index counted labels within their column, by falling row count, then by label.

    Numbering is distributed: labels are range-partitioned in output order,
    numbered inside each partition and shifted by the size of the partitions
    before it, so a column with very many labels does not end in one task.
    """
    order = [F.desc("n"), F.asc("label")]
    ranged = cut_lineage(
        counts.repartitionByRange(F.asc("feature"), *order).withColumn("_part", F.spark_partition_id())
    )
    parts = ranged.groupBy("feature", "_part").agg(F.count("*").alias("_size"))
    shift = F.sum("_size").over(Window.partitionBy("feature").orderBy("_part")) - F.col("_size")
    inside = F.row_number().over(Window.partitionBy("feature", "_part").orderBy(*order)) - 1
    return (
        ranged.withColumn("_inside", inside)
        .join(parts.withColumn("_shift", shift), ["feature", "_part"])
        .select("feature", "label", "n", (F.col("_inside") + F.col("_shift")).cast("bigint").alias("idx"))
    )


def label_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count and index the labels of each column: ``feature``, ``label``, ``n``, ``idx``."""
    return number_labels(label_counts(df, columns))


#: A label on more than this share of the counted rows is hot; there are at most a thousand such labels.
HOT_SHARE = 0.001
#: Shares into which rows that need no shuffle lookup any more are dealt.
_SALTS = 1_024


def encode_labels(df: DataFrame, column: str, index: DataFrame, out: str) -> DataFrame:
    """Look up the index of each row's label in a stored table; NULL for a label not indexed.

    A NULL label is looked up as the empty text, as the reader gives it. A list
    too long to broadcast is split: the few hot labels are broadcast, and only
    the others are looked up by a shuffle, through which rows of hot labels pass
    dealt out evenly. So no task gets all rows of one label, whatever adaptive
    execution does.
    """
    mine = index.filter(F.col("feature") == column)
    lookup = mine.select(F.col("label").alias("_label"), F.col("idx").alias(out))
    whole = measured(lookup)
    if whole is not lookup:
        return df.join(whole, filled(column) == F.col("_label"), "left").drop("_label")
    total = mine.agg(F.sum("n")).first()[0]
    hot = mine.filter(F.col("n") > HOT_SHARE * total).select(F.col("label").alias("_hot"), F.col("idx").alias("_known"))
    rest = mine.filter(F.col("n") <= HOT_SHARE * total).select(F.col("label").alias("_label"), F.least("idx", F.lit(0)).cast("int").alias("_zero"), F.col("idx").alias(out))
    # The zero is computed: a constant would be taken out of the join's keys, and with it the salt.
    settled = F.col("_known").isNotNull()
    salt = 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(_SALTS))
    keyed = df.join(F.broadcast(hot), filled(column) == F.col("_hot"), "left").withColumns(
        {"_key": F.when(~settled, filled(column)), "_salt": F.when(settled, salt).otherwise(0).cast("int")}
    )
    found = keyed.join(rest, (F.col("_key") == F.col("_label")) & (F.col("_salt") == F.col("_zero")), "left")
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_known", out).alias(out))
