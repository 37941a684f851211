"""Runs of repeated word sequences, found in tiles per octave of the period.

A run with period q in [S, 2S), S a power of two, and at least four periods has
a stretch of 3q >= 3S matches (positions i with word i equal to word i + q). It
therefore holds a whole block [b, b + S) of matches whose start b is a multiple
of 2S. Around every such boundary b a tile of 7S words is enough to follow the
matches as far as the next boundaries; what neighbouring tiles find of one run
overlaps and is stitched together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import whole_text, write_table
from loadlens.session import measured

#: A run has at least so many periods and words.
PERIODS, WORDS = 4, 6
#: Words of neighbouring tiles that travel together; a tile may be longer.
CHAIN = 4_096
#: Words in all tiles of a batch handed over, unless one tile is longer.
BATCH_WORDS = 2_000_000
_BLANKS = re.compile("[\x20\x09-\x0d]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """The words between blanks and the control characters 9 to 13."""
    return [w for w in _BLANKS.split(text) if w]


def numbered(words: list[str]) -> np.ndarray:
    """Equal words get equal numbers, in order of first appearance."""
    known: dict[str, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int32)


#: Periods up to this one are remembered, so that their multiples open no tile.
REMEMBERED = 16


def _reach(ids: np.ndarray, period: int) -> np.ndarray:
    """For each position, how many words from there on equal the word one period later."""
    same = ids[:-period] == ids[period:]
    place = np.arange(len(same))
    stop = np.minimum.accumulate(np.where(same, len(same), place)[::-1])[::-1]
    return np.concatenate([stop - place, np.zeros(period, np.int64)])


def boundaries(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """S and the boundaries at which a period of the octave may match over a whole block.

    Blocks are compared by polynomial sums modulo 2^64: equal blocks always have
    equal sums, so no boundary of a run is missed; what a chance collision lets
    through is settled in its tile. A match whose period is certainly a multiple
    of a short one found before (words compared) opens no tile.
    """
    n = len(ids)
    if n < WORDS:
        return
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    powers = np.cumprod(np.full(n, _BASE, np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed * powers, out=sums[1:])
    known: dict[int, np.ndarray] = {}
    size = 1
    while PERIODS * size <= n:
        starts = np.arange(0, n - 2 * size + 1, 2 * size)
        block = sums[size:] - sums[:-size]  # of the block at each position, times the power there
        # The partners b + q of one boundary are a block themselves: [b + S, b + 2S).
        partners = np.zeros(len(starts) * 2 * size, np.uint64)
        partners[: min(len(block), len(partners))] = block[: len(partners)]
        partners = partners.reshape(len(starts), 2 * size)[:, size:]
        shift = powers[size - 1 : 2 * size - 1]  # powers[q - 1] moves a sum by q
        hits = block[starts][:, None] * shift[None, :] == partners
        for d, reach in known.items():
            first = -size % d
            hits[:, first::d] &= reach[starts][:, None] < np.arange(size + first, 2 * size, d)[None, :] - d
        opened = hits.any(axis=1)
        if opened.any():
            yield size, starts[opened]
            if size <= REMEMBERED:
                for q in np.flatnonzero(hits.any(axis=0)) + size:
                    if q <= REMEMBERED:
                        known[int(q)] = _reach(ids, int(q))
        size *= 2


def chains(starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(boundary, count): neighbouring boundaries whose tiles travel as one row, up to ``CHAIN`` words."""
    most = max(1, CHAIN // (2 * size))
    for part in np.split(starts, np.flatnonzero(np.diff(starts) > 2 * size) + 1):
        for at in range(0, len(part), most):
            yield int(part[at]), min(most, len(part) - at)


def tile_range(size: int, boundary: int, n: int, count: int = 1) -> tuple[int, int]:
    """First word and end of the tile around a boundary, or of the tiles of ``count`` neighbours."""
    return max(0, boundary - 2 * size), min(n, boundary + (2 * count + 3) * size)


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of ``s`` and of its suffix at each position."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _prime_factors(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return [*found, q] if q > 1 else found


def fragments(words: list[int], size: int, at: int, low: int) -> Iterator[tuple[int, int, int]]:
    """(period, first, end): matches of a period of the octave across the boundary, within the tile.

    ``words`` is the tile, ``at`` the boundary in it, ``low`` its first word's
    number in the document. Two Z-functions from the boundary tell for every
    period how far its matches reach to the right and to the left. A period
    whose stretch repeats a shorter one is left to that one's octave. Stretches
    that end inside the tile and are too short for a run are dropped.
    """
    n = len(words)
    ahead = z_function(words[at:])
    hits = [q for q in range(size, min(2 * size, n - at)) if ahead[q] >= size]
    if not hits:
        return
    before = words[:at][::-1]
    mirrored = words[: min(at + 2 * size, n)][::-1]
    behind = z_function([*before, -1, *mirrored])[at + 1 :]
    for q in hits:
        if any(ahead[q // p] >= q - q // p for p in _prime_factors(q)):
            continue
        reach = min(ahead[q], 3 * size)
        back = behind[len(mirrored) - at - q] if at else 0
        first, end = at - back, at + reach
        open_left = back == at and low > 0
        open_right = reach == 3 * size or end + q == n
        if open_left or open_right or end - first + q >= max(WORDS, PERIODS * q):
            yield q, low + first, low + end


_TILE = "loc string, size int, boundary int, count int, low int, words array<int>"


def cut_tiles(docs: DataFrame, loc: str = "loc", text: str = "text") -> DataFrame:
    """Overlapping tiles of every document and octave where a period may match.

    A row (loc, size, boundary, count, low, words) holds ``count`` neighbouring
    tiles, the first one around ``boundary``. A word travels as its number within the document. Batches are handed over
    by size, so a document that is all tiles leaves the task bit by bit.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        locs, sizes, bounds, counts, lows, words = zip(*rows)
        offsets = np.cumsum([0, *map(len, words)], dtype=np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(words).astype(np.int32)))
        numbers = [pa.array(c, pa.int32()) for c in (sizes, bounds, counts, lows)]
        return pa.RecordBatch.from_arrays([pa.array(locs, pa.string()), *numbers, listed], ["loc", "size", "boundary", "count", "low", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for where, body in zip(batch.column("loc"), batch.column("text")):
                ids = numbered(words_of(body.as_py()))
                for size, starts in boundaries(ids):
                    for boundary, count in chains(starts, size):
                        low, end = tile_range(size, boundary, len(ids), count)
                        rows.append((where.as_py(), size, boundary, count, low, ids[low:end]))
                        held += end - low
                        if held >= BATCH_WORDS:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return docs.select(F.col(loc).alias("loc"), whole_text(text).alias("text")).mapInArrow(run, _TILE)


def solve_tiles(tiles: DataFrame) -> DataFrame:
    """Fragments of matches: loc, period, first, end. Every tile is solved on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            rows = [batch.column(c).to_pylist() for c in ("loc", "size", "boundary", "count", "low", "words")]
            for where, size, boundary, count, low, words in zip(*rows):
                for b in range(boundary, boundary + 2 * size * count, 2 * size):
                    first, end = tile_range(size, b, low + len(words))
                    found += [(where, *f) for f in fragments(words[first - low : end - low], size, b - first, first)]
            if found:
                locs, *numbers = zip(*found)
                columns = [pa.array(locs, pa.string()), *[pa.array(c, pa.int32()) for c in numbers]]
                yield pa.RecordBatch.from_arrays(columns, ["loc", "period", "first", "end"])

    return tiles.mapInArrow(run, "loc string, period int, first int, end int")


def stitch(found: DataFrame) -> DataFrame:
    """Whole runs (loc, start, length, period) from fragments that overlap or touch, per document and period."""
    ordered = Window.partitionBy("loc", "period").orderBy("first", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("first") > reached, 1).otherwise(0)
    runs = (
        found.withColumn("_new", fresh)
        .withColumn("_run", F.sum("_new").over(ordered))
        .groupBy("loc", "period", "_run")
        .agg(F.min("first").alias("start"), F.max("end").alias("end"))
        .select("loc", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
    )
    return runs.where(F.col("length") >= F.greatest(F.lit(WORDS), PERIODS * F.col("period")))


def _runs_type(c: Column) -> Column:
    return c.cast("array<struct<start:long,length:long,period:long>>")


def find_runs(docs: DataFrame, loc: str = "loc", text: str = "text") -> DataFrame:
    """loc and runs, an array of (start, length, period) in that order, of the documents with any."""
    tiles = write_table(cut_tiles(docs, loc, text), "tiles")
    # A long document's tiles go to many tasks.
    spread = tiles.repartition("loc", "size", "boundary")
    listed = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    runs = stitch(solve_tiles(spread)).groupBy("loc").agg(listed.alias("runs"))
    ordered = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    return write_table(runs.select("loc", _runs_type(ordered).alias("runs")), "runs")


def collapse(docs: DataFrame, keep: list[str], loc: str = "loc", text: str = "text") -> DataFrame:
    """The ``keep`` columns of located ``docs``, their runs, and the text with every run cut to its first period.

    Adds n_words, runs (start, length, period; by start, then period) and
    collapsed: the kept words joined by one blank. NULL and empty texts have no
    word, no run and the empty text; repeated rows are handled each for itself;
    an empty table gives an empty result; other columns are not read.
    """
    runs = measured(find_runs(docs, loc, text))
    names = [f"_{i}" for i in range(len(keep))]
    rows = docs.select(F.col(loc).alias("loc"), *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], whole_text(text).alias("__text"))
    joined = rows.join(runs, "loc", "left").select(*names, "__text", "runs")
    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            for body, found in zip(batch.column("__text"), batch.column("runs")):
                words = words_of(body.as_py())
                counts.append(len(words))
                if found.is_valid and len(found):
                    kept = np.ones(len(words), bool)
                    for r in found.as_py():
                        kept[r["start"] + r["period"] : r["start"] + r["length"]] = False
                    words = [words[i] for i in np.flatnonzero(kept)]
                texts.append(" ".join(words))
            columns = [*batch.columns[: len(names)], batch.column("runs"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "runs", "n_words", "collapsed"])

    runs_type = "array<struct<start:bigint,length:bigint,period:bigint>>"
    out = joined.mapInArrow(run, ", ".join(filter(None, [kinds, f"runs {runs_type}", "n_words long", "collapsed string"])))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.coalesce("runs", F.array().cast(runs_type)).alias("runs"), "n_words", "collapsed")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared in whole numbers; ties by start, then period."""

    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (
            F.when(left != right, F.when(left > right, -1).otherwise(1))
            .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
            .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
        )

    return F.get(F.array_sort(runs, order), F.lit(0))
