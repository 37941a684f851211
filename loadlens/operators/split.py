"""Subsamples and train/test splits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def random_sample(df: DataFrame, share: float, seed: int | None = None) -> DataFrame:
    return df.sample(share, seed)


def random_halves(df: DataFrame, share: float = 0.5, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Random split; repeatable only for the same partitioning of the same data."""
    first, second = df.randomSplit([share, 1.0 - share], seed)
    return first, second


def hash_bucket(key: str, buckets: int = 1000) -> Column:
    """Bucket of a row from the digest of its key, the same in every engine and run; a NULL key counts as the empty text."""
    digest = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(buckets))


def hash_split(df: DataFrame, key: str, share: float = 0.5, buckets: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Split by the key, so that a recomputed partition gives the same rows."""
    limit = round(share * buckets)
    bucket = hash_bucket(key, buckets)
    return df.filter(bucket < limit), df.filter(bucket >= limit)


def draw(key: str, seed: int) -> Column:
    """52 bits of the digest of seed and key: the row's place in a random order of all keys."""
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


_DIGITS, _SLOTS = 13, 4_096  # hexadecimal digits of a draw; slots of one search pass


def first_in_order(df: DataFrame, key: str, k: int, seed: int = 1) -> Column:
    """Whether a row is among the first ``k`` in the random order of the keys.

    The draw of the k-th row is searched by counting rows per slot, and the
    next pass splits only the slot that holds it: a few passes with at most
    4,096 counts each, however many rows there are. Rows of one draw stay
    together, so ``k`` is met exactly where draws differ: keys must be unique,
    and two of a million then share one of the 2^52 draws once in 9,000 tries.
    """
    place = draw(key, seed)
    low, width, before = 0, 16**_DIGITS, 0
    while width > 1:
        step = max(width // _SLOTS, 1)
        slot = F.floor((place - F.lit(low)) / step).cast("int")
        inside = df.where((place >= low) & (place < low + width)) if width < 16**_DIGITS else df
        counts = sorted(inside.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect())
        found = None
        for c in counts:
            if before + c.n >= k:
                found = c.slot
                break
            before += c.n
        if found is None:  # fewer than k rows
            return F.lit(True)
        low, width = low + found * step, step
    return place <= low


def exact_sample(df: DataFrame, key: str, k: int, seed: int = 1) -> DataFrame:
    """``k`` rows (all, if there are fewer; see ``first_in_order``), the same ones for any number of partitions.

    Keys are unique; each has the same chance, by the digest of seed and key.
    """
    return df.limit(0) if k <= 0 else df.where(first_in_order(df, key, k, seed))


def exact_halves(df: DataFrame, key: str, share: float = 0.5, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Random parts of exactly ``floor(share * n)`` and the remaining rows; a row is in one of them."""
    k = math.floor(share * df.count())
    chosen = first_in_order(df, key, k, seed) if k > 0 else F.lit(False)
    return df.where(chosen), df.where(~chosen)
