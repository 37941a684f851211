"""Random forest regression with trees that reach down to single rows.

``pyspark.ml`` holds arrays of every bin of every feature for each node, and
the whole forest in the driver. With nearly a leaf per row both grow with the
rows. Here only nodes with many rows are split by counts per bin over all
tasks, a level at a time. A node with few rows goes with its rows to one task
as a group of bounded size, which grows it to its leaves. The trees stay a
table: a row to score is sent to the group that it falls into.

A tree is the one that ``pyspark.ml`` describes: a Poisson bag of the rows, a
random subset of the features per node, thresholds between up to ``bins``
ranges of each feature, the split of greatest variance reduction. Bags and
subsets are drawn from hashes of content, so cores and layout do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.session import cut_lineage

# Most draws of a tree whose node is grown in one task.
SMALL_NODE = 200_000
# A prediction is a sum of whole numbers, so that its order does not matter.
_UNIT = 2.0**50
_NODE = np.dtype([("feature", "<i2"), ("cut", "<u2"), ("left", "<i4"), ("value", "<f8")])
_CHOICE = "slot int, j int, cut int, gain double, w double, q double, wl double, ql double"
_SENT = "tree int, node long, row long, data binary, value double"


@dataclass
class Settings:
    trees: int
    depth: int
    bins: int
    rows: float
    subset: int
    seed: int


def subset_size(columns: str, n: int, trees: int) -> int:
    """Features tried per node, by the learner's names, a share, or a number."""
    if columns == "auto":
        columns = "all" if trees == 1 else "onethird"
    named = {"all": n, "onethird": math.ceil(n / 3), "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n)))}
    if columns in named:
        return named[columns]
    return min(int(columns), n) if columns.isdigit() else math.ceil(float(columns) * n)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draws(keys: np.ndarray, s: Settings) -> np.ndarray:
    """How often each row is in the bag of each tree."""
    if s.trees == 1 and s.rows == 1.0:
        return np.ones((len(keys), 1), np.uint8)
    trees = _mixed(np.arange(s.trees) + (s.seed << 20))
    even = (_mixed(keys.view(np.uint64)[:, None] ^ trees[None, :]) >> np.uint64(11)) * 2.0**-53
    p = [math.exp(-s.rows)]
    for k in range(1, 40):
        p.append(p[-1] * s.rows / k)
    return np.searchsorted(np.cumsum(p)[:-1], even, side="right").astype(np.uint8)


def _subsets(trees: np.ndarray, nodes: np.ndarray, features: int, s: Settings) -> np.ndarray:
    """The features tried at each node."""
    at = _mixed(_mixed(trees + (s.seed << 20)) ^ nodes.astype(np.uint64))
    order = _mixed(at[:, None] + _mixed(np.arange(features))[None, :])
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, : s.subset], axis=1)


def _edges(rows: DataFrame, features: int, bins: int) -> list[list[float]]:
    """Thresholds per feature: between all values if they fit the bins, else at even ranks."""
    long = rows.select(F.posexplode(F.array(*[f"x{i}" for i in range(features)])).alias("feature", "x"))
    counts = cut_lineage(long.groupBy("feature", "x").agg(F.count("*").alias("n")))
    sizes = counts.groupBy("feature").agg(F.count("*").alias("size"), F.sum("n").alias("total")).collect()
    few = [r.feature for r in sizes if r["size"] <= bins]
    edges: list[list[float]] = [[] for _ in range(features)]
    values: dict[int, list[float]] = {f: [] for f in few}
    for r in counts.filter(F.col("feature").isin(few)).collect():
        values[r.feature].append(r.x)
    for f, v in values.items():
        v.sort()
        edges[f] = [(a + b) / 2 if a < (a + b) / 2 < b else a for a, b in zip(v, v[1:])]
    many = {r.feature: r.total for r in sizes if r["size"] > bins}
    if many:
        parts = max(rows.sparkSession.sparkContext.defaultParallelism, 1)
        ranged = counts.filter(F.col("feature").isin(list(many))).repartitionByRange(parts, "feature", "x")
        ranged = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
        sums = sorted(ranged.groupBy("part", "feature").agg(F.sum("n")).collect())
        before, starts = dict.fromkeys(many, 0), []
        for part, feature, n in sums:
            starts.append((part, feature, before[feature], many[feature]))
            before[feature] += n
        table = rows.sparkSession.createDataFrame(starts, "part int, feature int, start long, total long")
        upto = F.sum("n").over(Window.partitionBy("part", "feature").orderBy("x"))
        ranked = ranged.withColumn("upto", upto).join(F.broadcast(table), ["part", "feature"])
        place = F.floor((F.col("start") + F.col("upto") - F.col("n")) * bins / F.col("total"))
        for r in ranked.groupBy("feature", place.alias("bin")).agg(F.max("x").alias("x")).collect():
            edges[r.feature].append(r.x)
        for f in many:
            edges[f] = sorted(set(edges[f]))[:-1]
    return edges


def _binned(batch: pd.DataFrame, edges: list[list[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(e, batch[f"x{i}"].to_numpy(), side="left") for i, e in enumerate(edges)], axis=1).astype("<u2")


def _unpacked(data: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<u2").reshape(len(data), -1)


def _gain(wl, ql, w, q):
    """Reduction of the squared error by a split, from weights and sums to the left and in all."""
    wr = w - wl
    with np.errstate(divide="ignore", invalid="ignore"):
        found = wl * wr / w * (ql / wl - (q - ql) / wr) ** 2
    return np.where((wl > 0) & (wr > 0), found, 0.0)


def _route(top: np.ndarray, trees: int, x: np.ndarray) -> np.ndarray:
    """Index in ``top`` of the node where each row ends, per tree; the first nodes are the roots."""
    at = np.broadcast_to(np.arange(trees), (len(x), trees)).copy()
    while True:
        feature = top["feature"][at]
        row, tree = np.nonzero(feature >= 0)
        if not len(row):
            return at
        here = at[row, tree]
        at[row, tree] = top["left"][here] + (x[row, feature[row, tree]] > top["cut"][here])


def _splits(x: np.ndarray, q: np.ndarray, w: np.ndarray, slot: np.ndarray, total_w: np.ndarray, total_q: np.ndarray, tried: np.ndarray):
    """Per slot the greatest gain, its feature and its cut; the rows stand in the order of their slots.

    All sums are whole numbers below 2**53, so they are exact in any order.
    """
    n, size = x.shape
    best, feature, cut = np.zeros(len(tried)), np.full(len(tried), -1, "<i2"), np.zeros(len(tried), "<u2")
    flat, line, width = x.ravel(), np.arange(n) * size, int(x.max()) + 1
    starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    places = n.bit_length()
    for j in range(tried.shape[1]):
        bins = flat[line + tried[slot, j]]
        if len(tried) * width <= 2 * n:
            # Few slots: a place for every bin.
            cell = slot * width + bins
            wl, ql = (np.cumsum(np.bincount(cell, v, len(tried) * width).reshape(-1, width), axis=1) for v in (w, q))
            gain = _gain(wl, ql, total_w[:, None], total_q[:, None])
            at = np.argmax(gain, axis=1)
            of, most = np.arange(len(tried)), gain[np.arange(len(tried)), at]
        else:
            packed = np.sort((slot << 16 | bins) << places | np.arange(n), kind="stable")
            key, order = packed >> places, packed & ((1 << places) - 1)
            ends = np.flatnonzero(key[1:] != key[:-1])
            of = key[ends] >> 16
            inner = of == key[ends + 1] >> 16
            ends, of = ends[inner], of[inner]
            if not len(ends):
                continue
            up_w, up_q = np.cumsum(w[order]), np.cumsum(q[order])
            first = starts[of] - 1
            wl = up_w[ends] - np.where(first < 0, 0.0, up_w[first])
            ql = up_q[ends] - np.where(first < 0, 0.0, up_q[first])
            gain = _gain(wl, ql, total_w[of], total_q[of])
            begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            most = np.maximum.reduceat(gain, begin)
            hits = np.flatnonzero(gain == np.repeat(most, np.diff(np.r_[begin, len(of)])))
            hits = hits[np.r_[True, of[hits][1:] != of[hits][:-1]]]
            of, most, at = of[hits], gain[hits], key[ends[hits]] & 0xFFFF
        better = most > best[of]
        of = of[better]
        best[of], feature[of], cut[of] = most[better], tried[of, j], at[better]
    return best, feature, cut


def _grow(x: np.ndarray, y: np.ndarray, q: np.ndarray, w: np.ndarray, tree: int, node: int, s: Settings) -> np.ndarray:
    """The nodes below ``node``, all levels at once per step; children lie side by side."""
    slot = np.zeros(len(x), np.int64)
    ids, made, base = np.array([node], np.int64), [], 0
    level = node.bit_length() - 1
    while len(ids):
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        total_w, total_q = np.add.reduceat(w, starts), np.add.reduceat(q, starts)
        nodes = np.zeros(len(ids), _NODE)
        nodes["feature"] = -1
        low, high = np.minimum.reduceat(y, starts), np.maximum.reduceat(y, starts)
        nodes["value"] = np.clip(np.add.reduceat(w * y, starts) / total_w, low, high)
        best = np.zeros(len(ids))
        # Nodes of one value are leaves: no split of them gains anything.
        mixed = np.flatnonzero(low < high)
        if level < s.depth and len(mixed):
            tried = _subsets(np.full(len(mixed), tree), ids[mixed], x.shape[1], s)
            if len(mixed) < len(ids):
                here = (low < high)[slot]
                part = (x[here], q[here], w[here], (np.cumsum(low < high) - 1)[slot[here]])
            else:
                part = (x, q, w, slot)
            best[mixed], nodes["feature"][mixed], nodes["cut"][mixed] = _splits(*part, total_w[mixed], total_q[mixed], tried)
        split = best > 0
        base += len(ids)
        rank = np.cumsum(split) - 1
        nodes["left"] = np.where(split, base + 2 * rank, 0)
        made.append(nodes)
        left = 2 * ids[split]
        ids = np.stack([left, left + 1], axis=1).ravel()
        stay = split[slot]
        x, y, q, w, slot = x[stay], y[stay], q[stay], w[stay], slot[stay]
        right = x[np.arange(len(x)), nodes["feature"][slot]] > nodes["cut"][slot]
        slot = 2 * rank[slot] + right
        order = np.argsort(slot, kind="stable")
        x, y, q, w, slot = x[order], y[order], q[order], w[order], slot[order]
        level += 1
    return np.concatenate(made)


@dataclass
class DeepForest:
    """Thresholds, the upper nodes of all trees, and a table of the lower ones."""

    settings: Settings
    edges: list[list[float]]
    centre: float
    scale: float
    top: np.ndarray
    ids: list[int]
    pieces: DataFrame

    def note(self) -> dict:
        return {
            "settings": vars(self.settings),
            "edges": self.edges,
            "centre": self.centre,
            "scale": self.scale,
            "top": self.top.tolist(),
            "ids": self.ids,
        }

    @staticmethod
    def of(note: dict, pieces: DataFrame) -> DeepForest:
        top = np.array([tuple(n) for n in note["top"]], _NODE)
        return DeepForest(Settings(**note["settings"]), note["edges"], note["centre"], note["scale"], top, note["ids"], pieces)

    def predict(self, df: DataFrame, keep: list[str], features: str) -> DataFrame:
        """``keep`` and the mean of the trees, ``prediction``, for every row."""
        s, edges, top, centre, scale = self.settings, self.edges, self.top, self.centre, self.scale
        ids = np.array(self.ids, np.int64)
        whole = np.isnan(top["value"])  # ends in a piece
        inputs = [F.col(features)[i].alias(f"x{i}") for i in range(len(edges))]
        names = {c: f"_keep_{i}" for i, c in enumerate(keep)}
        stored = cut_lineage(
            df.select(*[F.col(c).alias(n) for c, n in names.items()], *inputs, F.monotonically_increasing_id().alias("_row"))
        )

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = _binned(b, edges)
                data = [r.tobytes() for r in x]
                at = _route(top, s.trees, x)
                for t in range(s.trees):
                    yield pd.DataFrame(
                        {"tree": t, "node": ids[at[:, t]], "row": b["_row"], "data": data, "value": top["value"][at[:, t]]}
                    )

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            piece = np.zeros(0, _NODE)
            for b in batches:
                tree, node, row = (b[c].to_numpy() for c in ("tree", "node", "row"))
                value = b["value"].to_numpy(dtype=float).copy()
                new = (tree[1:] != tree[:-1]) | (node[1:] != node[:-1]) | (row[:-1] < 0)
                cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(b)]
                for low, high in zip(cuts, cuts[1:]):
                    if low == high:
                        continue
                    if row[low] < 0:
                        piece = np.frombuffer(b["data"].iloc[low], _NODE)
                    elif np.isnan(value[low]):
                        x = _unpacked(b["data"].iloc[low:high])
                        value[low:high] = piece["value"][_route(piece, 1, x)[:, 0]]
                real = row >= 0
                units = np.rint((value[real] - centre) / scale * _UNIT).astype(np.int64)
                yield pd.DataFrame({"_row": row[real], "units": units})

        x = [f"x{i}" for i in range(len(edges))]
        sent = stored.select("_row", *x).mapInPandas(send, _SENT)
        if whole.any():
            lower = self.pieces.select("tree", "node", F.lit(-1).cast("long").alias("row"), "data", F.lit(float("nan")).alias("value"))
            sent = sent.unionByName(lower).repartition(_parts(df.sparkSession, s.trees, len(ids)), "tree", "node")
        units = sent.sortWithinPartitions("tree", "node", "row").mapInPandas(judge, "_row long, units long")
        total = units.groupBy("_row").agg(F.sum("units").alias("_units"))
        mean = F.lit(centre) + F.lit(scale) * (F.col("_units") / (s.trees * _UNIT))
        joined = stored.drop(*x).join(total, "_row")
        return joined.select(*[F.col(n).alias(c) for c, n in names.items()], mean.alias("prediction"))


def _parts(spark: SparkSession, trees: int, nodes: int) -> int:
    return 2 * max(trees, nodes, spark.sparkContext.defaultParallelism)


def fit(df: DataFrame, target: str, features: str, size: int, place: str, s: Settings) -> DeepForest:
    """Grow a forest on the array column ``features`` of ``size`` numbers.

    ``place`` is a hash of a row's content; rows that share it lie side by side in one partition.
    """
    spark = df.sparkSession
    inputs = [F.col(features)[i].alias(f"x{i}") for i in range(size)]
    rows = cut_lineage(df.select(F.col(target).cast("double").alias("y"), F.col(place).alias("place"), *inputs))
    n, low, high = rows.agg(F.count("*"), F.min("y"), F.max("y")).first()
    if not n:
        raise ValueError("no rows to learn from")
    edges = _edges(rows, size, s.bins)
    centre, scale = low / 2 + high / 2, (high / 2 - low / 2) or 1.0
    grain = 2.0 ** (51 - (int(2 * n * max(s.rows, 1.0)) + 1024).bit_length())

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, seen = None, 0
        for b in batches:
            if not len(b):
                continue
            place = b["place"].to_numpy()
            new = np.r_[last is None or place[0] != last, place[1:] != place[:-1]]
            begin = np.maximum.accumulate(np.where(new, np.arange(len(b)), -seen))
            copy = np.arange(len(b)) - begin
            last, seen = place[-1], int(copy[-1]) + 1
            key = _mixed(place.view(np.uint64) ^ _mixed(copy)).view(np.int64)
            yield pd.DataFrame({"key": key, "y": b["y"], "data": [r.tobytes() for r in _binned(b, edges)]})

    known = rows.mapInPandas(number, "key long, y double, data binary").persist()
    try:
        top, ids = _upper(known, size, s, centre, scale, grain)
        whole = np.isnan(top["value"])
        node_ids = np.array(ids, np.int64)

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                at, draws = _route(top, s.trees, _unpacked(b["data"])), _draws(b["key"].to_numpy(), s)
                for t in range(s.trees):
                    mine = whole[at[:, t]] & (draws[:, t] > 0)
                    yield pd.DataFrame(
                        {"tree": t, "node": node_ids[at[mine, t]], "key": b["key"][mine], "y": b["y"][mine], "w": draws[mine, t], "data": b["data"][mine]}
                    )

        def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("key", kind="stable")
            y, w = group["y"].to_numpy(), group["w"].to_numpy().astype(float)
            q = np.rint((y - centre) / scale * grain) * w
            nodes = _grow(_unpacked(group["data"]), y, q, w, int(key[0]), int(key[1]), s)
            return pd.DataFrame({"tree": [key[0]], "node": [key[1]], "data": [nodes.tobytes()]})

        sent = known.mapInPandas(send, "tree int, node long, key long, y double, w short, data binary")
        pieces = (
            sent.repartition(_parts(spark, s.trees, len(ids)), "tree", "node")
            .groupBy("tree", "node")
            .applyInPandas(grow, "tree int, node long, data binary")
        )
        return DeepForest(s, edges, centre, scale, top, ids, cut_lineage(pieces))
    finally:
        known.unpersist()


def _upper(known: DataFrame, size: int, s: Settings, centre: float, scale: float, grain: float) -> tuple[np.ndarray, list[int]]:
    """The nodes with more than ``SMALL_NODE`` draws and their children, split a level at a time.

    A node without a value has few draws, and is left to the second part.
    """

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = sum((_draws(b["key"].to_numpy(), s).sum(axis=0, dtype=np.int64) for b in batches), np.zeros(s.trees, np.int64))
        yield pd.DataFrame({"tree": np.arange(s.trees), "n": n})

    found = known.mapInPandas(weigh, "tree int, n long").groupBy("tree").agg(F.sum("n").alias("n")).collect()
    sizes = {r.tree: r.n for r in found}
    top = np.zeros(s.trees, _NODE)
    top["feature"], top["value"] = -1, math.nan
    trees, ids = list(range(s.trees)), [1] * s.trees
    for t in range(s.trees):
        if not sizes.get(t):
            top["value"][t] = centre  # an empty bag
    open_nodes = [t for t in range(s.trees) if sizes.get(t, 0) > SMALL_NODE]
    while open_nodes:
        tried = _subsets(np.array([trees[i] for i in open_nodes]), np.array([ids[i] for i in open_nodes], np.int64), size, s)
        slots = np.full(len(top), -1)
        slots[open_nodes] = np.arange(len(open_nodes))
        counted = known.mapInPandas(_counter(top, slots, tried, s, centre, scale, grain), "slot int, w binary, q binary")
        step = counted.groupBy("slot").applyInPandas(_chooser(s), _CHOICE)
        more, following = [], []
        for r in sorted(step.collect()):
            i = open_nodes[r.slot]
            if r.gain <= 0:
                top["value"][i] = centre + scale * (r.q / r.w / grain)
                continue
            top["feature"][i], top["cut"][i], top["left"][i] = tried[r.slot, r.j], r.cut, len(top) + len(more)
            top["value"][i] = 0.0
            for side, (w, q) in enumerate([(r.wl, r.ql), (r.w - r.wl, r.q - r.ql)]):
                trees.append(trees[i])
                ids.append(2 * ids[i] + side)
                at_limit = ids[-1].bit_length() - 1 >= s.depth
                if not at_limit and w > SMALL_NODE:
                    following.append(len(top) + len(more))
                more.append((-1, 0, 0, centre + scale * (q / w / grain) if at_limit else math.nan))
        top = np.concatenate([top, np.array(more, _NODE)])
        open_nodes = following
    return top, ids


def _counter(top: np.ndarray, slots: np.ndarray, tried: np.ndarray, s: Settings, centre: float, scale: float, grain: float):
    """Weights and sums per open node, tried feature and bin, of the rows of a task."""
    shape = (*tried.shape, s.bins)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_w, all_q = np.zeros(shape), np.zeros(shape)
        for b in batches:
            x, draws = _unpacked(b["data"]), _draws(b["key"].to_numpy(), s)
            q = np.rint((b["y"].to_numpy() - centre) / scale * grain)
            slot = slots[_route(top, s.trees, x)]
            row, tree = np.nonzero((slot >= 0) & (draws > 0))
            of, w = slot[row, tree], draws[row, tree].astype(float)
            for j in range(tried.shape[1]):
                cell = of * s.bins + x[row, tried[of, j]]
                all_w[:, j] += np.bincount(cell, w, len(tried) * s.bins).reshape(len(tried), s.bins)
                all_q[:, j] += np.bincount(cell, w * q[row], len(tried) * s.bins).reshape(len(tried), s.bins)
        for i in np.flatnonzero(all_w[:, 0].any(axis=1)):
            yield pd.DataFrame({"slot": [i], "w": [all_w[i].tobytes()], "q": [all_q[i].tobytes()]})

    return count


def _chooser(s: Settings):
    """The best split of a node from the counts of all tasks."""

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        w, q = (sum(np.frombuffer(v).reshape(-1, s.bins) for v in group[c]) for c in ("w", "q"))
        all_w, all_q = w[0].sum(), q[0].sum()
        wl, ql = np.cumsum(w, axis=1), np.cumsum(q, axis=1)
        gain = _gain(wl, ql, all_w, all_q)
        j, cut = np.unravel_index(np.argmax(gain), gain.shape)
        return pd.DataFrame(
            {"slot": [group["slot"].iloc[0]], "j": [j], "cut": [cut], "gain": [gain[j, cut]], "w": [all_w], "q": [all_q], "wl": [wl[j, cut]], "ql": [ql[j, cut]]}
        )

    return choose
