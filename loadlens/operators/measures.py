"""Error, histograms and error profile of scored rows from one pass."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.constants import BIN_WIDTH
from loadlens.functions.bins import edge, edge_count, interval, nearest_edge
from loadlens.functions.cleaning import present
from loadlens.operators.evaluate import error_of
from loadlens.session import cut_lineage

# Values beyond this many bins are counted as lying there; a bin number stays a whole number.
_FAR = 2**52


@dataclass
class Measures:
    """What ``measure`` counted; each part is a small table over the stored sums."""

    error: DataFrame
    histogram: DataFrame
    profile: DataFrame


def _sums(df: DataFrame, actual: str | None, predicted: str, width: float) -> DataFrame:
    """(kind, bin, n, on_edge, total, squares, top) of the bins that have rows, stored.

    Kinds: interval of the actual value, interval of the prediction, edge
    nearest to the actual value. Bins are numbered without knowing the last
    edge; ``on_edge`` counts the values that lie on the lower edge.
    """
    w = float(width)
    y = present(F.col(actual).cast("double")) if actual else F.lit(None).cast("double")
    p = present(F.col(predicted).cast("double"))
    error = error_of(y, p)
    far = F.lit(_FAR * w)

    def row(kind: str, x: Column, place: Column) -> Column:
        held = F.least(F.greatest(x, -far), far)
        return F.struct(F.lit(kind).alias("kind"), place.alias("bin"), x.alias("x"), (held == edge(place, w)).alias("on_edge"))

    def inside(x: Column) -> Column:
        held = F.least(F.greatest(x, -far), far)
        return F.when(held < 0, F.lit(-1)).otherwise(interval(F.greatest(held, F.lit(0.0)), w, _FAR))

    kinds = F.array(row("actual", y, inside(y)), row("predicted", p, inside(p)), row("profile", y, nearest_edge(y, w, _FAR)))
    kind = F.col("_k.kind")
    return cut_lineage(
        df.select(error.alias("_e"), F.explode(kinds).alias("_k"))
        .groupBy(kind.alias("kind"), F.col("_k.bin").alias("bin"))
        .agg(
            F.when(kind == "profile", F.count("_e")).otherwise(F.count("_k.x")).alias("n"),
            F.count_if("_k.on_edge").alias("on_edge"),
            F.sum(F.abs("_e")).alias("total"),
            F.sum(F.col("_e") * F.col("_e")).alias("squares"),
            F.max(F.when(F.abs("_k.x") < float("inf"), F.col("_k.x"))).alias("top"),
        )
    )


def measure(df: DataFrame, actual: str | None, predicted: str, width: float = BIN_WIDTH, upper: float | None = None) -> Measures:
    """RMSE, histograms of actual and predicted values, and error profile, with one pass over ``df``.

    The histograms reach up to ``upper``, by default one edge past the largest
    value; the profile up to the largest actual value. Rows are counted once per
    bin, and what depends on the last edge is settled on these counts: it closes
    the last interval and takes all that lies beyond it in the profile. Without
    ``actual`` (scoring) only the predictions are counted; a missing value is in
    no bin, a row without both values is not in the error.
    """
    spark = df.sparkSession
    sums = _sums(df, actual, predicted, width)
    tops = {r.kind: r.top for r in sums.groupBy("kind").agg(F.max("top").alias("top")).collect()}
    reach = lambda *kinds: max((edge_count(math.ceil(tops[k]), width) for k in kinds if tops.get(k) is not None), default=0)
    edges = reach("actual", "predicted") + 1 if upper is None else edge_count(upper, width)
    last = reach("actual")
    error = sums.where("kind = 'profile'").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sqrt(F.sum("squares") / F.sum("n")).alias("rmse")
    )
    names = {"actual": actual, "predicted": predicted}
    wanted = [k for k in ("actual", "predicted") if names[k]]
    # The last interval is closed: what lies on the last edge belongs into it.
    closed = F.when(F.col("bin") == edges - 1, F.struct(F.lit(edges - 2).cast("bigint").alias("bin"), F.col("on_edge").alias("n")))
    counted = (
        sums.where("kind <> 'profile'")
        .select("kind", F.coalesce(closed, F.struct("bin", "n")).alias("_c"))
        .groupBy(F.col("_c.bin").alias("bin"))
        .agg(*[F.sum(F.when(F.col("kind") == k, F.col("_c.n"))).alias(k) for k in wanted])
    )
    grid = lambda count: spark.range(max(count, 0)).withColumnRenamed("id", "bin")
    histogram = grid(edges - 1).join(counted, "bin", "left")
    histogram = histogram.select("bin", edge(F.col("bin"), width).alias("lower"), *[F.coalesce(k, F.lit(0)).alias(f"n_{names[k].lower()}") for k in wanted])
    near = (
        sums.where("kind = 'profile' and bin is not null")
        .groupBy(F.least("bin", F.lit(last - 1)).alias("bin"))
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    profile = (
        grid(last)
        .join(near, "bin", "left")
        .select("bin", edge(F.col("bin"), width).alias("edge"), F.coalesce("n", F.lit(0)).alias("n"), F.expr("try_divide(total, n)").alias("mean_abs_error"))
    )
    return Measures(error, histogram, profile)
