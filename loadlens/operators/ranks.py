"""Exact order statistics by counting, without gathering the values.

A quantile of a big column must not pull that column into one task. Quantiles
read the rows twice, whatever the size of a group: a mergeable sketch first
gives a bracket around the wanted rank, then the values in the bracket are
counted, those below it only as one number. What is stored then is a few
hundredths of the rows at most, and the value at the rank is looked for there.

A rank in a long list is searched by slots: count per slot of the value range,
keep the slot in which the rank falls and split only that one again, until it
holds a single value. Each pass is one map-side-combined count with a bounded
number of slots.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.cleaning import present
from loadlens.session import as_lookup, cut_lineage, measured

# Most values of one group that are put in order in one task.
SMALL_GROUP = 250_000
# The first pass cuts every power of two in this many slots: at most
# 2 * 1024 * 64 slots over all doubles, some hundreds for load times.
_SLOTS_PER_OCTAVE = 64
# Later passes cut the open range evenly.
_SLOTS = 16_384
# Size of a sketch, and the share of ranks to both sides of the wanted one that its bracket spans: some
# six times the error that a sketch of this size has in one of a hundred cases. A bracket that misses is noticed.
_SKETCH, _MARGIN = 1_024, 0.02


def join_on(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which NULL equals NULL; the keys come out once."""
    right = other.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = df.join(right, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def _first_slot(x: Column) -> Column:
    size = F.floor(F.log2(F.abs(x.cast("double")) + 1.0) * _SLOTS_PER_OCTAVE)
    return F.when(x < 0, -size - 1).otherwise(size)


def _inner_slot(x: Column, low: Column, high: Column) -> Column:
    """Slot of ``x`` in ``[low, high]``; the two ends never share a slot."""
    return F.least(F.floor((x - low) / (high - low) * _SLOTS), F.lit(_SLOTS - 1))


def _range_counts() -> list[Column]:
    return [F.sum("_w").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]


def _bracket(sketch: str, q: float) -> tuple[Column, Column]:
    """Values that the sketch puts a margin below and above the quantile; unbounded at the ends."""
    low, high = q - _MARGIN, q + _MARGIN
    at = lambda rank: F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank)))
    least, most = F.lit(float("-inf")), F.lit(float("inf"))
    return (at(low) if low > 0 else least), (at(high) if high < 1 else most)


def percentiles(df: DataFrame, value: str, percents: list[float], margin: bool = True) -> list[float | None]:
    """Linearly interpolated percentiles of a whole column, as driver scalars.

    Two passes over the rows, shared by all percentiles; only slot counts reach
    the driver. ``margin=False`` brackets the whole column: what is done anyway
    should a sketch have missed.
    """
    column = df.select(present(F.col(value).cast("double")).alias("_v")).filter("_v is not null")
    ends = [(float("-inf"), float("inf"))]
    if margin:
        sketched = column.agg(F.kll_sketch_agg_double("_v", _SKETCH).alias("s"), F.count("*").alias("n"))
        wanted = [F.when(F.col("n") > 0, F.struct(*_bracket("s", p / 100.0))) for p in percents]
        first = sketched.select("n", *[w.alias(f"b{i}") for i, w in enumerate(wanted)]).first()
        if first["n"] == 0:
            return [None] * len(percents)
        ends = []
        for low, high in sorted(tuple(first[f"b{i}"]) for i in range(len(percents))):
            if ends and low <= ends[-1][1]:
                ends[-1] = (ends[-1][0], max(high, ends[-1][1]))
            else:
                ends.append((low, high))
    # Parts in order: even ones are the gaps, counted as one number each; odd ones the brackets, value by value.
    v = F.col("_v")
    part = F.lit(0)
    for i, (low, high) in enumerate(ends):
        part = F.when(v > high, 2 * i + 2).when(v >= low, 2 * i + 1).otherwise(part)
    placed = column.select(part.alias("_part"), "_v")
    counted = cut_lineage(placed.groupBy("_part", F.when(F.col("_part") % 2 == 1, v).alias("_v")).agg(F.count("*").alias("_w")))
    parts = sorted(counted.groupBy("_part").agg(*_range_counts()).collect())
    total = sum(r["_n"] for r in parts)
    if total == 0:
        return [None] * len(percents)
    positions = [p / 100.0 * (total - 1) for p in percents]
    ranks = sorted({r for h in positions for r in (math.floor(h), math.ceil(h))})
    brackets = {r: _pick(parts, r) for r in ranks}
    if any(b[1] is None for b in brackets.values()):  # a rank in a gap
        return percentiles(df, value, percents, margin=False)
    found = _descend(counted.filter("_v is not null"), brackets)
    answers = []
    for h in positions:
        below, above = found[math.floor(h)], found[math.ceil(h)]
        answers.append(below if below == above else below + (above - below) * (h - math.floor(h)))
    return answers


def _pick(slots, rank: int, before: int = 0) -> tuple[int, float, float]:
    """The slot holding ``rank``: rows before it, its least and greatest value."""
    for s in slots:
        if rank < before + s["_n"]:
            return before, s["_low"], s["_high"]
        before += s["_n"]
    raise ValueError("rank beyond the number of rows")


def _descend(column: DataFrame, brackets: dict[int, tuple[int, float, float]]) -> dict[int, float]:
    v = F.col("_v")
    while True:
        still_open = sorted({b for b in brackets.values() if b[1] < b[2]})
        if not still_open:
            return {rank: b[1] for rank, b in brackets.items()}
        place = F.lit(None)
        for i, (_, low, high) in enumerate(still_open):
            here = F.struct(F.lit(i).alias("b"), _inner_slot(v, F.lit(low), F.lit(high)).alias("s"))
            place = F.when(v.between(low, high), here).otherwise(place)
        rows = (
            column.select("_v", "_w", place.alias("_at"))
            .filter("_at is not null")
            .groupBy(F.col("_at.b").alias("_b"), F.col("_at.s").alias("_slot"))
            .agg(*_range_counts())
            .collect()
        )
        split = {b: sorted((r["_slot"], r) for r in rows if r["_b"] == i) for i, b in enumerate(still_open)}
        for rank, b in brackets.items():
            if b in split:
                brackets[rank] = _pick([r for _, r in split[b]], rank, b[0])


def values_at_ranks(df: DataFrame, keys: list[str], value: str, targets: DataFrame, weight: Column | None = None) -> DataFrame:
    """Value at a rank (0-based, ascending) of each group, for groups of any size.

    ``targets`` holds the keys and a column ``_rank``; several ranks per group
    are allowed. Returns keys, ``_rank`` and ``_value``. A NULL key is a group
    too. A row counts ``weight`` times.
    """
    rows = df.select(*keys, present(value).alias("_v"), (F.lit(1) if weight is None else weight).alias("_w")).filter("_v is not null")
    first = (
        join_on(rows, as_lookup(targets.select(*keys).distinct()), keys, "left_semi")
        .groupBy(*keys, _first_slot(F.col("_v")).alias("_slot"))
        .agg(*_range_counts())
    )
    through = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slot"))
    state = (
        join_on(first.withColumn("_before", through - F.col("_n")), targets, keys)
        .filter("_rank >= _before and _rank < _before + _n")
        .select(*keys, "_rank", "_before", "_low", "_high")
    )
    while True:
        state = cut_lineage(state)
        still_open = state.filter("_low < _high")
        if still_open.isEmpty():
            return state.select(*keys, "_rank", F.col("_low").alias("_value"))
        marks = [*keys, "_rank", "_start"]
        brackets = still_open.withColumnsRenamed({"_before": "_start", "_low": "_l", "_high": "_h"})
        split = (
            join_on(rows, as_lookup(brackets), keys)
            .filter("_v between _l and _h")
            .groupBy(*marks, _inner_slot(F.col("_v"), F.col("_l"), F.col("_h")).alias("_slot"))
            .agg(*_range_counts())
        )
        through = F.sum("_n").over(Window.partitionBy(*marks).orderBy("_slot"))
        narrowed = (
            split.withColumn("_before", F.col("_start") + through - F.col("_n"))
            .filter("_rank >= _before and _rank < _before + _n")
            .select(*keys, "_rank", "_before", "_low", "_high")
        )
        state = state.filter("_low = _high").unionByName(narrowed)


def grouped_quantile(
    df: DataFrame, keys: list[str], value: str, q: float, more: list[Column] | None = None, small: int = SMALL_GROUP, margin: float = _MARGIN, many: bool = False
) -> DataFrame:
    """Exact interpolated quantile per group: keys, the aggregates ``more``, and ``_quantile``.

    Two passes over the rows: sketch and aggregates, then the counts around the
    wanted rank. With ``many`` groups, most of them short, they are counted
    first, and values that a sketch would hold anyway are put in order as a
    list; only longer groups take the two passes. ``small`` bounds the
    values of one group's list or bracket that are put in order in one task;
    longer brackets are searched by slots. A group without a value has NULL.
    """
    v = present(F.col(value).cast("double"))
    if not many:
        return _by_bracket(df, keys, v, q, more or [], small, margin)
    most = min(_SKETCH, small)
    sized = df.groupBy(*keys).agg(F.count(v).alias("_size"))
    n_short, n_long = sized.agg(F.count_if(F.col("_size") <= most), F.count_if(F.col("_size") > most)).first()
    if not n_long:
        return _by_list(df, keys, v, q, more or [])
    if not n_short:
        return _by_bracket(df, keys, v, q, more or [], small, margin)
    long = as_lookup(sized.filter(F.col("_size") > most).select(*keys))
    listed = _by_list(join_on(df, long, keys, "left_anti"), keys, v, q, more or [])
    return listed.unionByName(_by_bracket(join_on(df, long, keys, "left_semi"), keys, v, q, more or [], small, margin))


def _weighed(low: Column, high: Column, place: Column) -> Column:
    """As the built-in aggregate weighs the two."""
    return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)


def _by_list(df: DataFrame, keys: list[str], v: Column, q: float, more: list[Column]) -> DataFrame:
    """``grouped_quantile`` of groups with few values."""
    found = df.groupBy(*keys).agg(*more, F.sort_array(F.collect_list(v + 0.0)).alias("_all"))  # no negative zero
    place = F.lit(q) * (F.size("_all") - 1)
    at = lambda rank: F.get("_all", rank.cast("int"))
    return found.withColumn("_quantile", F.when(F.size("_all") > 0, _weighed(at(F.floor(place)), at(F.ceil(place)), place))).drop("_all")


def _by_bracket(df: DataFrame, keys: list[str], v: Column, q: float, more: list[Column], small: int, margin: float) -> DataFrame:
    """``grouped_quantile`` of groups of any size."""
    sketched = [F.count(v).alias("_size"), F.kll_sketch_agg_double(v, _SKETCH).alias("_sketch")]
    first = df.groupBy(*keys).agg(*more, *sketched)
    names = [c for c in first.columns if c not in ("_size", "_sketch")]
    low, high = _bracket("_sketch", q)
    if margin >= 1:
        low, high = F.lit(float("-inf")), F.lit(float("inf"))
    filled_in = F.col("_size") > 0
    groups = cut_lineage(
        first.select(*names, "_size", F.when(filled_in, low).alias("_low"), F.when(filled_in, high).alias("_high"), (F.lit(q) * (F.col("_size") - 1)).alias("_at"))
    )
    answers = _in_brackets(df, keys, v, groups, small)
    missed = groups.filter("_size > 0").select(*keys)
    missed = cut_lineage(join_on(missed, answers, keys, "left_anti"))
    if not missed.isEmpty():  # a sketch was off: the whole of these groups is counted
        again = join_on(groups, as_lookup(missed), keys, "left_semi").withColumns({"_low": F.lit(float("-inf")), "_high": F.lit(float("inf"))})
        answers = answers.unionByName(_in_brackets(df, keys, v, cut_lineage(again), small))
    return join_on(groups.select(*names), measured(cut_lineage(answers)), keys, "left")


def _in_brackets(df: DataFrame, keys: list[str], v: Column, groups: DataFrame, small: int) -> DataFrame:
    """keys and _quantile of the groups whose bracket holds the wanted rank."""
    bounds = measured(groups.filter("_size > 0").select(*keys, "_low", "_high"))
    rows = join_on(df.select(*keys, v.alias("_v")).filter("_v is not null"), bounds, keys).filter("_v <= _high")
    counted = cut_lineage(rows.groupBy(*keys, F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v")).agg(F.count("*").alias("_w")))
    spots = groups.select(*keys, "_at", F.floor("_at").alias("_lower"), F.ceil("_at").alias("_upper"))
    sizes = counted.groupBy(*keys).agg(F.count("_v").alias("_values"), F.sum("_w").alias("_reach"), F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_w"))), F.lit(0)).alias("_below"))
    held = cut_lineage(join_on(spots, sizes, keys).filter("_lower >= _below and _upper < _reach"))
    short = held.filter(F.col("_values") <= small)
    through = F.sum("_w").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")))
    ordered = join_on(counted, measured(short.select(*keys, "_at", "_lower", "_upper")), keys).withColumn("_to", through)
    at = lambda rank: F.max(F.when((F.col("_to") - F.col("_w") <= F.col(rank)) & (F.col(rank) < F.col("_to")), F.col("_v")))
    found = ordered.groupBy(*keys, "_at").agg(at("_lower").alias("_lo"), at("_upper").alias("_hi"))
    long = held.filter(F.col("_values") > small)
    if not long.isEmpty():
        ranks = lambda c: long.select(*keys, (F.col(c) - F.col("_below")).alias("_rank"))
        values = values_at_ranks(counted, keys, "_v", ranks("_lower").unionByName(ranks("_upper")).distinct(), F.col("_w"))
        searched = join_on(long.select(*keys, "_at"), values, keys).groupBy(*keys, "_at").agg(F.min("_value").alias("_lo"), F.max("_value").alias("_hi"))
        found = found.unionByName(searched)
    return found.select(*keys, _weighed(F.col("_lo"), F.col("_hi"), F.col("_at")).alias("_quantile"))


def group_quantile(df: DataFrame, keys: list[str], value: str, q: float, small: int = SMALL_GROUP) -> DataFrame:
    """Exact interpolated quantile per group: keys and ``_quantile``."""
    return grouped_quantile(df, keys, value, q, small=small)


def cutoffs(df: DataFrame, keys: list[str], order: str, counts: DataFrame, small: int = SMALL_GROUP) -> DataFrame:
    """Order value of the ``_take``-th row of each group: keys and ``_cut``.

    ``counts`` holds keys, ``_take`` (at least 1) and ``_size``, the row count of
    the group. ``order`` must be unique and numeric.
    """
    targets = counts.select(*keys, (F.least("_take", "_size") - 1).alias("_rank"), "_size")
    big = targets.filter(F.col("_size") > small)
    ranked = Window.partitionBy(*keys).orderBy(order)
    picked = (
        join_on(df.select(*keys, order), as_lookup(targets.filter(F.col("_size") <= small)), keys)
        .withColumn("_row", F.row_number().over(ranked) - 1)
        .filter("_row = _rank")
        .select(*keys, F.col(order).alias("_cut"))
    )
    if big.isEmpty():
        return picked
    searched = values_at_ranks(df, keys, order, big.drop("_size")).select(*keys, F.col("_value").alias("_cut"))
    return picked.unionByName(searched)


def first_rows(df: DataFrame, keys: list[str], order: str, k: int, small: int = SMALL_GROUP) -> DataFrame:
    """The first ``k`` rows of each group by a unique numeric column."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    counts = cut_lineage(sizes.withColumn("_take", F.lit(k)))
    limits = cutoffs(df, keys, order, counts, small)
    return join_on(df, as_lookup(limits), keys).filter(F.col(order) <= F.col("_cut")).select(*df.columns)
