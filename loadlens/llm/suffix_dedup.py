"""Remove byte strings that occur earlier, by suffix sorting around shared anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import small_batches, whole_text, write_table
from loadlens.llm.grouping_sort import longest_earlier_match
from loadlens.session import measured

#: A string of so many bytes that occurs earlier is removed.
LENGTH = 100
#: Every such string holds an anchor: the smallest hash among its strings of this many bytes.
GRAM = 32
_GRAMS = LENGTH - GRAM + 1
#: Kinds in a group around one anchor that one task sorts: a megabyte or two. Larger groups are compared window by window.
SORTED_GROUP = 5_000
#: In such groups so many neighbouring windows are compared at once before single ones are.
_BLOCK = 8
#: Bytes that are hashed, and symbols that are sorted, at once.
_CHUNK, _ROWS = 1 << 20, 20_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.iinfo(np.int64).max


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes:
    """Tables for rolling hashes modulo 2**64."""

    def __init__(self) -> None:
        self.byte = _spread(np.arange(1, 257, dtype=np.uint64) * _MIX)
        base = int(_spread(np.array([77], dtype=np.uint64))[0]) | 1
        self.power = np.full(_CHUNK + 2 * LENGTH, base, dtype=np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power, dtype=np.uint64)
        inverse = np.full(len(self.power), pow(base, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)

    def grams(self, values: np.ndarray) -> np.ndarray:
        """Hash of the GRAM bytes from each position."""
        h, size = values, 1
        while size < GRAM:
            h = h[:-size] * self.power[size] + h[size:]
            size *= 2
        return _spread(h)


def anchors_of(data: np.ndarray, bounds: np.ndarray, hashes: _Hashes) -> tuple[np.ndarray, ...]:
    """Runs of window starts that share an anchor, over texts laid end to end.

    ``bounds`` are the text ends. Gives first start, number of starts, anchor
    position, anchor hash, and the hash of the bytes that the run's windows
    cover together with the run's place at its anchor.
    """
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(3)) + tuple(np.zeros(0, dtype=np.uint64) for _ in range(2))
    if len(data) < LENGTH:
        return none
    values = hashes.byte[data]
    gram = hashes.grams(values)
    place = np.arange(len(gram), dtype=np.uint64)
    low = (gram & ~np.uint64(0xFFFFFF)) | place  # leftmost of equal hashes
    size = 1
    while size * 2 <= _GRAMS:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = _GRAMS - size
    low = np.minimum(low[: len(low) - rest], low[rest:])
    valid = np.ones(len(low), dtype=bool)
    for end in bounds[:-1]:
        valid[max(0, end - LENGTH + 1) : end] = False
    start = np.nonzero(valid)[0]
    if not len(start):
        return none
    at = (low[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)))
    where = np.nonzero(new)[0]
    first, count, anchor = start[where], np.diff(np.append(where, len(start))), at[where]
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values * hashes.power[: len(values)], dtype=np.uint64)))
    covered = (prefix[first + count - 1 + LENGTH] - prefix[first]) * hashes.inverse[first]
    shape = (count.astype(np.uint64) << np.uint64(8)) | (anchor - first).astype(np.uint64)
    return first, count, anchor, gram[anchor], _spread(covered ^ _spread(shape * _MIX))


_ANCHOR = "o long, t long, h long, c long, first long, count int, off int"


def anchors(texts: DataFrame, hashes_only: bool = False) -> DataFrame:
    """One row per run of windows: text (o, t), anchor hash h, content hash c, first start, count, offset of the anchor.

    With ``hashes_only`` a row is h alone.
    """

    def pieces(pdf: pd.DataFrame) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
        """Texts, and overlapping parts of very long ones, in bounded chunks."""
        keys: list[tuple[int, int, int]] = []
        parts: list[bytes] = []
        size = 0
        for o, t, text in zip(pdf["o"], pdf["t"], pdf["text"]):
            raw = text.encode("utf-8", "surrogatepass")
            for at in range(0, max(1, len(raw) - LENGTH + 1), _CHUNK):
                part = raw[at : at + _CHUNK + LENGTH - 1]
                if len(part) < LENGTH:
                    continue
                if size + len(part) > _CHUNK + LENGTH and parts:
                    yield keys, parts
                    keys, parts, size = [], [], 0
                keys.append((o, t, at))
                parts.append(part)
                size += len(part)
        if parts:
            yield keys, parts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for pdf in batches:
            for keys, parts in pieces(pdf):
                bounds = np.cumsum([len(p) for p in parts])
                first, count, anchor, h, c = anchors_of(np.frombuffer(b"".join(parts), dtype=np.uint8), bounds, hashes)
                if hashes_only:
                    yield pd.DataFrame({"h": h.view(np.int64)})
                    continue
                text = np.searchsorted(bounds, first, side="right")
                key = np.array(keys, dtype=np.int64).reshape(-1, 3)[text]
                begin = first - (bounds - [len(p) for p in parts])[text] + key[:, 2]
                yield pd.DataFrame(
                    {
                        "o": key[:, 0],
                        "t": key[:, 1],
                        "h": h.view(np.int64),
                        "c": c.view(np.int64),
                        "first": begin,
                        "count": count.astype(np.int32),
                        "off": (anchor - first).astype(np.int32),
                    }
                )

    return texts.select("o", "t", "text").mapInPandas(run, "h long" if hashes_only else _ANCHOR)


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(-1, width), sizes


def _depths(group: np.ndarray, parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order of (group, bytes), the common depth of each with the row before, and the deepest match of each row."""
    m, sizes = _matrix(parts, width)
    wide = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), m, sizes.astype(np.uint8).reshape(-1, 1)], axis=1)
    order = np.argsort(np.ascontiguousarray(wide).view(f"V{wide.shape[1]}").ravel(), kind="stable")
    a, g, s = m[order], group[order], sizes[order]
    differ = a[1:] != a[:-1]
    equal = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    depth = np.zeros(len(order), dtype=np.int64)
    depth[1:] = np.where(g[1:] == g[:-1], np.minimum(equal, np.minimum(s[1:], s[:-1])), -1)
    depth[0] = -1
    deepest = np.zeros(len(order), dtype=np.int64)
    deepest[order] = np.maximum(np.maximum(depth, np.append(depth[1:], -1)), 0)
    return order, depth, deepest


def _classes(group: np.ndarray, parts: list[bytes], width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, depth, class) at each depth where rows of a group part, for rows that share the class."""
    order, depth, deepest = _depths(group, parts, width)
    n = len(order)
    cut = np.zeros((int(group.max()) + 1, width + 1), dtype=bool)
    inside = depth >= least
    cut[group[order][inside], depth[inside]] = True
    rows, levels, marks = [], [], []
    at = np.arange(n)
    for d in np.nonzero(cut.any(axis=0))[0]:
        begins = np.maximum.accumulate(np.where(depth < d, at, 0))
        use = cut[group[order], d] & (deepest[order] >= d)
        rows.append(order[use])
        levels.append(np.full(use.sum(), d))
        marks.append(begins[use] * (width + 1) + d)
    if not rows:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return np.concatenate(rows), np.concatenate(levels), np.concatenate(marks)


def repeats_in(pdf: pd.DataFrame) -> pd.DataFrame:
    """Window starts (o, t, first, stop) whose string occurs earlier among rows of the same anchor.

    ``pdf`` has whole groups of runs: o, t, h, first, count, off, bytes. Texts
    of the same o are not earlier than one another, so a group that has such
    texts is searched for strings of smaller o, and each text for its own.
    """
    if pdf.empty:
        return _repeats(pdf, [])
    tied = pdf.groupby(["h", "o"])["t"].transform("nunique") > 1
    tied = tied.groupby(pdf["h"]).transform("any")
    plain = _repeats(pdf[~tied], ["h"])
    if not tied.any():
        return plain
    return pd.concat([plain, _repeats(pdf[tied], ["h"], smaller_o=True), _repeats(pdf[tied], ["h", "o", "t"])], ignore_index=True)


def _repeats(pdf: pd.DataFrame, keys: list[str], smaller_o: bool = False) -> pd.DataFrame:
    """The window starts of ``repeats_in`` within groups of the same ``keys``.

    In a group two windows are equal exactly if they have the same place at the
    anchor and the texts agree to the left and to the right of it far enough.
    Each run becomes a short sequence of symbols: the bytes between two places
    where members of the group part are one symbol. These sequences are suffix
    sorted, and the longest earlier match of each suffix says which windows
    are repeats. Earlier is smaller (o, t, place), or o with ``smaller_o``.
    """
    none = pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in ("o", "t", "first", "stop")})
    if pdf.empty:
        return none
    anchor = (pdf["first"] + pdf["off"]).to_numpy()
    group = pdf.groupby(keys).ngroup().to_numpy(np.int64)
    off = pdf["off"].to_numpy().astype(np.int64)
    left = [b[:f][::-1] for b, f in zip(pdf["bytes"], off)]
    right = [b[f : f + LENGTH] for b, f in zip(pdf["bytes"], off)]
    # Runs that share too little with any other have no repeat and are none.
    reach = _depths(group, left, _GRAMS)[2] + _depths(group, right, LENGTH)[2] >= LENGTH
    if not reach.any():
        return none
    keep = np.nonzero(reach)[0]
    keep = keep[np.lexsort((anchor[keep], pdf["t"].to_numpy()[keep], pdf["o"].to_numpy()[keep], group[keep]))]
    group = pd.factorize(group[keep])[0].astype(np.int64)
    left, right, off, anchor = [left[i] for i in keep], [right[i] for i in keep], off[keep], anchor[keep]
    key_o, key_t = pdf["o"].to_numpy()[keep], pdf["t"].to_numpy()[keep]
    count = pdf["count"].to_numpy().astype(np.int64)[keep]
    n = len(keep)
    l_row, l_depth, l_mark = _classes(group, left, _GRAMS, 1)
    r_row, r_depth, r_mark = _classes(group, right, LENGTH, 1)
    # Symbols of a row: left ones from outside in, right ones from inside out, an end that nothing equals.
    row = np.concatenate([l_row, r_row, np.arange(n)])
    side = np.concatenate([np.zeros(len(l_row)), np.ones(len(r_row)), np.full(n, 2)]).astype(np.int64)
    level = np.concatenate([-l_depth, r_depth, np.zeros(n, dtype=np.int64)])
    mark = np.concatenate([l_mark * 2, r_mark * 2 + 1, 2 * (np.arange(n) + (n + 1) * (LENGTH + 1))])
    order = np.lexsort((level, side, row))
    row, side, level = row[order], side[order], level[order]
    symbols = np.unique(mark[order], return_inverse=True)[1].astype(np.int64)
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (key_o[1:] != key_o[:-1])))
    longest = np.array(longest_earlier_match(symbols, np.cumsum(new)[row] if smaller_o else None), dtype=np.int64)
    # Of each row: where its right symbols begin.
    begin_right = np.searchsorted(row * 3 + side, np.arange(n) * 3 + 1)
    n_right = np.bincount(row[side == 1], minlength=n)
    # Suffixes from every left symbol, and from the anchor itself (left depth 0).
    at = np.concatenate([np.nonzero(side == 0)[0], begin_right])
    of = np.concatenate([row[side == 0], np.arange(n)])
    depth = np.concatenate([-level[side == 0], np.zeros(n, dtype=np.int64)])
    matched = np.minimum(longest[at] - (begin_right[of] - at), n_right[of])
    has = matched > 0
    at, of, depth, matched = at[has], of[has], depth[has], matched[has]
    extent = level[begin_right[of] + matched - 1]
    # Windows that begin r before the anchor, for r above the next smaller left depth of the row.
    previous = np.where(at + 1 < begin_right[of], -level[np.minimum(at + 1, len(level) - 1)], 0)
    r_low = np.maximum(np.where(depth == 0, 0, previous + 1), LENGTH - extent)
    r_low = np.maximum(r_low, off[of] - count[of] + 1)
    r_high = np.minimum(depth, off[of])
    good = r_low <= r_high
    of, r_low, r_high = of[good], r_low[good], r_high[good]
    return pd.DataFrame({"o": key_o[of], "t": key_t[of], "first": anchor[of] - r_high, "stop": anchor[of] - r_low + 1})


_CONTEXT = "o long, t long, h long, first long, count int, off int, bytes binary"
_SPAN = "o long, t long, first long, stop long"


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes that the windows of each wanted run cover."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for o, t, text, runs in zip(pdf["o"], pdf["t"], pdf["text"], pdf["runs"]):
                raw = text.encode("utf-8", "surrogatepass")
                rows += [(o, t, r["h"], r["first"], r["count"], r["off"], raw[r["first"] : r["first"] + r["count"] - 1 + LENGTH]) for r in runs]
            yield pd.DataFrame(rows, columns=["o", "t", "h", "first", "count", "off", "bytes"])

    per_text = wanted.groupBy("o", "t").agg(F.collect_list(F.struct("h", "first", "count", "off")).alias("runs"))
    per_text = write_table(per_text, "wanted")
    near = texts.select("o", "t", "text").join(measured(per_text.select("o", "t")), ["o", "t"], "left_semi")
    return near.join(per_text, ["o", "t"]).mapInPandas(run, _CONTEXT)


def _sorted_groups(contexts: DataFrame) -> DataFrame:
    """Repeats within groups of bounded size; a task takes its groups one after another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= _ROWS:
                whole = pd.concat(held, ignore_index=True)
                open_group = (whole["h"] == whole["h"].iloc[-1]).to_numpy()
                yield repeats_in(whole[~open_group])
                held = [whole[open_group]]
                size = int(open_group.sum())
        if held:
            yield repeats_in(pd.concat(held, ignore_index=True))

    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartition(parts, "h").sortWithinPartitions("h").mapInPandas(run, _SPAN)


def _firsts(rows: DataFrame, keys: list[str], at: str, more: list[str], tied: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows that no row of the same keys precedes, with the columns ``more``, and (o, t, at) of the first of each later row.

    A row precedes another by a smaller o, or within its text by a smaller
    ``at``. Unless some o has several texts (``tied``), one row of a kind is first.
    """
    here = F.struct("o", "t", at)
    if not tied:
        kinds = rows.groupBy(*keys).agg(F.min(F.struct("o", "t", at, *more)).alias("one"), F.count(F.lit(1)).alias("n"))
        kinds = write_table(kinds.select(*keys, "n", "one.*"), name)
        again = kinds.where("n > 1").select(*keys, here.alias("_first"))
        return kinds.drop("n"), rows.drop("part").join(again, keys).where(here != F.col("_first")).drop("_first")
    own = rows.groupBy(*keys, "o", "t").agg(F.min(F.struct(at, *more)).alias("one"))
    own = write_table(own.select(*keys, "o", "t", "one.*"), name)
    least = own.groupBy(*keys).agg(F.min("o").alias("_least"))
    kinds = write_table(own.join(least, keys).where(F.col("o") == F.col("_least")).drop("_least"), name)
    marked = kinds.select(*keys, "o", "t", F.col(at).alias("_first"))
    later = rows.drop("part").join(marked, [*keys, "o", "t"], "left").where(F.col("_first").isNull() | (F.col(at) != F.col("_first")))
    return kinds, later.drop("_first")


def _window_repeats(contexts: DataFrame, tied: bool) -> DataFrame:
    """Repeats in groups too large for one task.

    Windows go in blocks of neighbours at the same place from the anchor.
    Blocks of equal bytes are settled as a whole; only the first of each kind
    are taken apart into their windows, and these are grouped by their digest.
    The earliest window of a kind always lies in the earliest block of a kind.
    """
    far, near = F.col("off"), F.col("off") - F.col("count") + 1
    blocks = F.sequence(F.floor(near / _BLOCK), F.floor(far / _BLOCK))
    top = F.least(F.col("b") * _BLOCK + _BLOCK - 1, far)
    size = (top - F.greatest(F.col("b") * _BLOCK, near) + 1).cast("int")
    begin = (far - top).cast("int")
    part = F.substring("bytes", begin + 1, size - 1 + LENGTH)
    pieces = contexts.select("*", F.explode(blocks).alias("b")).select("o", "t", (F.col("first") + begin).alias("at"), size.alias("size"), part.alias("part"))
    pieces = pieces.withColumn("w", F.unhex(F.md5("part")))
    kinds, later = _firsts(pieces, ["w"], "at", ["size", "part"], tied, "blocks")
    whole = later.select("o", "t", F.col("at").alias("first"), (F.col("at") + F.col("size")).alias("stop"))
    i = F.col("i")
    windows = kinds.select("o", "t", "at", "part", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i")).select(
        "o", "t", (F.col("at") + i).alias("at"), F.unhex(F.md5(F.substring("part", i + 1, F.lit(LENGTH)))).alias("w")
    )
    if tied:
        single = _firsts(windows, ["w"], "at", [], tied, "windows")[1]
    else:
        here = F.struct("o", "t", "at")
        first = windows.groupBy("w").agg(F.min(here).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
        first = write_table(first.select("w", "earliest"), "windows")
        single = windows.join(first, "w").where(here != F.col("earliest"))
    return whole.unionByName(single.select("o", "t", F.col("at").alias("first"), (F.col("at") + 1).alias("stop")))


def repeated_windows(texts: DataFrame, sorted_group: int = SORTED_GROUP, tied: bool = True) -> DataFrame:
    """(o, t, first, stop): starts of strings of LENGTH bytes that occur earlier.

    ``texts`` has o, t, text; earlier means smaller o, or the same text (o, t)
    and a smaller start. ``tied`` says that an o may have several texts. Runs of
    windows with equal bytes are settled by their hashes; only where texts
    around one anchor differ are bytes compared.
    """
    # The texts are hashed twice: the runs of all texts, most of them shared by none, would fill more disk than the texts.
    # Stored, so that the join may split a hot anchor: an aggregate in the same stage would hold it together.
    often = write_table(anchors(texts, hashes_only=True).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "often")
    shared = write_table(anchors(texts).join(often, "h"), "shared")
    unlike, later = _firsts(shared, ["h", "c"], "first", ["count", "off"], tied, "contents")
    copies = later.select("o", "t", "first", (F.col("first") + F.col("count")).alias("stop"))
    sizes = write_table(unlike.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "kinds")
    wanted = unlike.join(sizes, "h").select("h", "kinds", "o", "t", "first", "count", "off")
    contexts = write_table(_contexts(texts, wanted), "contexts")
    small = contexts.join(sizes.where(F.col("kinds") > sorted_group), "h", "left_anti")
    large = contexts.join(sizes.where(F.col("kinds") > sorted_group), "h", "left_semi")
    return copies.unionByName(_sorted_groups(small)).unionByName(_window_repeats(large, tied))


def _cut(raw: bytes, starts: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, what is left) for runs of repeated window starts."""
    removed, spans, kept, at = 0, 0, [], 0
    low = high = -1
    for first, stop in [*sorted(starts), (len(raw) + 1, len(raw) + 1)]:
        if first <= high:
            high = max(high, stop - 1 + LENGTH)
            continue
        if high > low:
            removed, spans = removed + high - low, spans + 1
            kept.append(raw[at:low])
            at = high
        low, high = first, stop - 1 + LENGTH
    kept.append(raw[at:])
    return removed, spans, b"".join(kept)


def _removals(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(o, t, n_removed, n_spans, kept) of the texts that lose bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for o, t, text, runs in zip(pdf["o"], pdf["t"], pdf["text"], pdf["runs"]):
                removed, n, left = _cut(text.encode("utf-8", "surrogatepass"), [(r["first"], r["stop"]) for r in runs])
                rows.append((o, t, removed, n, hashlib.sha256(left).hexdigest(), left))
            yield pd.DataFrame(rows, columns=["o", "t", "n_removed", "n_spans", "kept_sha256", "kept"])

    per_text = write_table(spans.groupBy("o", "t").agg(F.collect_list(F.struct("first", "stop")).alias("runs")), "spans")
    near = texts.select("o", "t", "text").join(measured(per_text.select("o", "t")), ["o", "t"], "left_semi")
    return near.join(per_text, ["o", "t"]).mapInPandas(run, "o long, t long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, loc: str = "loc", sorted_group: int = SORTED_GROUP, with_bytes: bool = False) -> DataFrame:
    """loc, doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of located ``docs``.

    Every byte covered by a string of LENGTH bytes that also starts earlier is
    removed: in a smaller doc_id (NULL counts as the greatest), or before it in
    the same row. Rows with the same id are documents of which none is earlier.
    NULL is the empty text. Of identical texts only the first is searched; rows
    of its id get its result, the others are repeats as a whole. With
    ``with_bytes`` the bytes left are returned as ``kept`` where some were
    removed. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession, 200)
    o = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(loc).alias("loc"), o.alias("o"), F.xxhash64(loc).alias("t"), whole_text().alias("text"))
    plain = write_table(body.select("loc", "doc_id", "o", "t", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    firsts = plain.groupBy("sha").agg(F.min(F.struct("o", "t")).alias("first"), F.count(F.lit(1)).alias("n"))
    same = measured(write_table(firsts.where("n > 1").select("sha", "first"), "same"))
    twin = F.when(F.col("o") == F.col("first.o"), F.col("first.t"))
    copies = plain.join(same, "sha").where(F.struct("o", "t") != F.col("first")).select("o", "t", twin.alias("twin"))
    copies = write_table(copies, "copies")
    texts = body.select("o", "t", "text").where(F.octet_length("text") >= LENGTH).join(measured(copies.select("o", "t")), ["o", "t"], "left_anti")
    searched = plain.where(F.col("n_bytes") >= LENGTH).join(copies, ["o", "t"], "left_anti")
    tied = not searched.groupBy("o").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    cut = _removals(texts, repeated_windows(texts, sorted_group, tied))
    cut = write_table(cut if with_bytes else cut.drop("kept"), "cut")
    cut = cut.withColumnRenamed("t", "searched")
    whole = copies.withColumn("copied", F.when(F.col("twin").isNull(), F.lit(True)))
    found = plain.join(whole, ["o", "t"], "left").withColumn("searched", F.coalesce("twin", "t")).join(cut, ["o", "searched"], "left")
    gone = F.col("copied").isNotNull() & (F.col("n_bytes") >= LENGTH)

    def pick(whole_copy: Column, name: str, untouched: Column) -> Column:
        return F.when(gone, whole_copy).otherwise(F.coalesce(F.col(name), untouched)).alias(name)

    return found.select(
        "loc",
        "doc_id",
        "n_bytes",
        pick(F.col("n_bytes"), "n_removed", F.lit(0)),
        pick(F.lit(1), "n_spans", F.lit(0)),
        pick(F.sha2(F.lit(""), 256), "kept_sha256", F.col("sha")),
        *([F.col("kept")] if with_bytes else []),
    )
