"""Mix sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.session import as_lookup

SEED = "mix-1"
#: A larger mean is drawn as a sum of parts with at most this mean, so that exp() cannot underflow.
PART_MEAN = 500.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a SHA-256 over the parts."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5, size: float = 1.0) -> DataFrame:
    """(source, rate): mean number of copies that gives each source its weight.

    A source's weight is given in ``weights`` (sources that it does not name
    get 0) or is its share of code points to ``power``. The expected output
    has ``size`` times the code points of the input. NULL is a source too; a
    source without any character keeps its documents once on average.
    """
    chars = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("chars"))
    if weights is None:
        want = F.sqrt("chars") if power == 0.5 else F.pow(F.col("chars").cast("double"), F.lit(float(power)))
    else:
        want = F.coalesce(*[F.when(F.col("source").eqNullSafe(s), F.lit(float(w))) for s, w in weights.items()], F.lit(0.0))
    stored = as_lookup(chars.select("source", "chars", want.alias("want")))
    wants, total = stored.agg(F.sum(F.round("want", 6)), F.sum("chars")).first()
    rate = F.col("want") * F.lit(float(size) * float(total or 0)) / (F.lit(float(wants or 1)) * F.col("chars"))
    return stored.select("source", F.when(F.col("chars") > 0, rate).otherwise(F.lit(1.0)).alias("rate"))


def _with_cdf(rates: DataFrame) -> DataFrame:
    """Add the number of parts of each rate and the distribution function of one part.

    The function is tabulated well past the point where it rounds to 1.
    """
    rate = F.col("rate")
    parts = F.greatest(F.ceil(rate / PART_MEAN), F.lit(1)).cast("int")
    mean = F.col("part_mean")
    last = F.ceil(mean + 10 * F.sqrt(mean) + 20).cast("int")
    p0 = F.exp(-mean)
    start = F.struct(F.array(p0).alias("cdf"), p0.alias("p"), p0.alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(F.array_append(acc["cdf"], acc["c"] + p).alias("cdf"), p.alias("p"), (acc["c"] + p).alias("c"))

    return (
        rates.withColumn("parts", parts)
        .withColumn("part_mean", rate / F.col("parts"))
        .select("source", "rate", "parts", F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"].alias("cdf"))
    )


def copies(key: Column, seed: str = SEED) -> Column:
    """Poisson count of a row from its key: invert the tabulated function at hash-seeded numbers."""

    def draw(i: Column) -> Column:
        u = uniform(F.lit(seed), key, i.cast("string"))
        return F.size(F.filter("cdf", lambda c: c <= u))

    one = F.size(F.filter("cdf", lambda c: c <= F.col("u0")))
    many = F.aggregate(F.sequence(F.lit(0), F.col("parts") - 1), F.lit(0), lambda acc, i: acc + draw(i))
    return F.when(F.col("parts") == 1, one).otherwise(many)


def mix_sources(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5, size: float = 1.0, seed: str = SEED
) -> DataFrame:
    """Each document as often as its draw says, in one global random order.

    Adds ``copy`` (1, 2, ...), ``copies`` and ``mix_key``, by which the rows are
    sorted; a clashing column of the input is replaced. The draw depends on
    seed and doc_id only (on the text where doc_id is NULL), so a rerun and any
    partitioning give the same rows; repeated rows get the same draw each. An
    empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("copy", "copies", "mix_key")]
    rates = as_lookup(_with_cdf(source_rates(docs, weights, power, size)).withColumnRenamed("source", "rate_source"))
    # The input travels as one struct, so its columns cannot meet those of the draw.
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256))
    drawn = (
        body.join(rates, F.col("row.source").eqNullSafe(F.col("rate_source")))
        .withColumn("u0", uniform(F.lit(seed), key, F.lit("0")))
        .withColumn("copies", copies(key, seed))
        .where("copies > 0")
        .select("row", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .withColumn("mix_key", F.sha2(F.concat_ws("|", F.lit(seed), F.lit("order"), key, F.col("copy").cast("string")), 256))
    )
    return drawn.select("row.*", "copies", "copy", "mix_key").orderBy("mix_key")
