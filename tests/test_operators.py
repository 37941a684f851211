"""Filters, errors, profiles, splits, segments and rebalancing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.operators import evaluate, histogram, segments, split, trim
from loadlens.operators.profile import column_profile
from loadlens.operators.rebalance import rebalance


def test_trim(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    assert trim.trim_above_percentile(df, "x", 100).count() == 100
    counts = [trim.trim_above_percentile(df, "x", p).count() for p in (50, 90, 95, 99)]
    assert counts == sorted(counts) and counts[0] == 50
    assert 93 <= trim.trim_above_percentile(df, "x", 95, accuracy=100).count() <= 95
    same = spark.createDataFrame([(1.0,)] * 5, "x double")
    assert trim.trim_above_percentile(same, "x", 95).count() == 0


def test_ranges_and_audit(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (10,)], "x int")
    assert [r.x for r in trim.keep_range(df, "x", at_least=0, below=10).collect()] == [0, 5]
    assert [r.x for r in trim.keep_range(df, "x", above=0).collect()] == [5, 10]
    assert trim.audit(df, {"high": F.col("x") > 4}).first().asDict() == {"n_rows": 4, "high": 2}


def test_errors(spark):
    a = spark.createDataFrame([(3.0, 0.0)], "y double, p double")
    b = spark.createDataFrame([(4.0, 0.0), (1.0, 1.0)], "y double, p double")
    assert evaluate.pooled_rmse([a, b], "y", "p").first().rmse == pytest.approx(math.sqrt(25 / 3))
    base = evaluate.baseline_rmse(b, "y").first()
    assert (base["n"], base["mean"], base["rmse"]) == (2, 2.5, 1.5)
    assert evaluate.baseline_rmse(b, "y", 1.0).first().rmse == pytest.approx(math.sqrt(4.5))
    by = {r.s: r.rmse for r in evaluate.rmse(b.withColumn("s", F.col("p") > 0), "y", "p", ["s"]).collect()}
    assert by == {False: 4.0, True: 0.0}


def test_histogram_and_profile(spark):
    rng = np.random.default_rng(3)
    y, p = rng.uniform(0, 9.7, 400), rng.uniform(0, 9.7, 400)
    y[:3] = [0.25, 0.75, 9.5]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    edges = np.arange(0, math.ceil(y.max()), 0.5)
    assert histogram.edges_for(df, "y") == len(edges)
    got = histogram.histogram(df, ["y", "p"], 0.5, edges=len(edges)).orderBy("bin").collect()
    assert [r.n_y for r in got] == np.histogram(y, bins=edges)[0].tolist()
    assert [r.n_p for r in got] == np.histogram(p, bins=edges)[0].tolist()
    near = np.argmin(np.abs(edges[None, :] - y[:, None]), axis=1)
    profile = histogram.error_profile(df, "y", "p").orderBy("bin").collect()
    assert len(profile) == len(edges)
    for i, r in enumerate(profile):
        errors = np.abs(y - p)[near == i]
        assert r.n == len(errors)
        assert (r.mean_abs_error is None) if not len(errors) else r.mean_abs_error == pytest.approx(errors.mean())
    parts = histogram.pooled_error_profile([df.filter("p < 5"), df.filter("p >= 5")], "y", "p").orderBy("bin").collect()
    assert [(r.n, r.mean_abs_error and round(r.mean_abs_error, 9)) for r in parts] == [
        (r.n, r.mean_abs_error and round(r.mean_abs_error, 9)) for r in profile
    ]


def test_empty_bins_are_kept(spark):
    df = spark.createDataFrame([(0.0, 1.0), (3.6, 1.0)], "y double, p double")
    assert [r.n_y for r in histogram.histogram(df, "y", 1.0, edges=5).orderBy("bin").collect()] == [1, 0, 0, 1]
    assert [r.mean_abs_error for r in histogram.error_profile(df, "y", "p", 1.0).orderBy("bin").collect()] == [
        1.0,
        None,
        None,
        pytest.approx(2.6),
    ]


def test_splits(spark):
    df = spark.range(5000)
    first, second = split.hash_split(df, "id", 0.3)
    assert first.intersect(second).count() == 0 and first.count() + second.count() == 5000
    assert 0.25 < first.count() / 5000 < 0.35
    assert sorted(r.id for r in first.collect()) == sorted(r.id for r in split.hash_split(df.repartition(7), "id", 0.3)[0].collect())
    one, two = split.random_halves(df)
    assert one.count() + two.count() == 5000
    assert 0 < split.random_sample(df, 0.1, 3).count() < 1000


def test_segments(spark):
    rows = [("a", 1.0), ("a", 9.0), ("a", 10.0), ("b", 1.0), ("b", 15.0), ("c", 8.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    slow = segments.slow_groups(df, "v", ["g"], 8.0)
    assert [r.g for r in slow.collect()] == ["a"]
    assert segments.rows_in(df, slow, ["g"]).count() == 3
    assert segments.rows_not_in(df, slow, ["g"]).count() == 3
    fast, late = segments.split_by_flag(segments.flag_rows(df, slow, ["g"]), "is_slow")
    assert {r.g for r in fast.collect()} == {"b", "c"} and {r.g for r in late.collect()} == {"a"}


def wanted_copies(rows, width, target, whole, mode):
    """Copies per key, counted one bin at a time from the definition."""
    y = np.array([v for _, v in rows])
    edges = np.arange(0, math.ceil(y.max()), width)
    near = np.argmin(np.abs(edges[None, :] - y[:, None]), axis=1)
    inside = np.append(np.histogram(y, bins=edges)[0], 0)
    copies = {}
    for b in range(len(edges)):
        members = sorted(k for (k, _), at in zip(rows, near) if at == b)
        n = int(inside[b]) if mode == "compat" else len(members)
        last = mode == "compat" and b == len(edges) - 1
        for place, k in enumerate(members):
            if b < whole or (n > target and not last):
                times = 1
            elif n == 0 or last:
                times = 0
            else:
                rest = target % n
                more = rest + 1 if mode == "compat" and rest else rest
                times = target // n + (place < more)
            if times:
                copies[k] = times
    return copies


@pytest.mark.parametrize("mode", ["compat", "clean"])
@pytest.mark.parametrize("small", [10**9, 5])
def test_rebalance(spark, mode, small):
    rng = np.random.default_rng(11)
    y = np.round(np.concatenate([rng.exponential(3, 400), [14.6, 14.7, 15.2, 17.9]]), 2)
    rows = [(int(k), float(v)) for k, v in zip(rng.permutation(len(y)) * 3, y)]
    df = spark.createDataFrame(rows, "k bigint, y double")
    out = rebalance(df, "y", "k", width=0.5, target=37, whole_bins=4, mode=mode, small=small)
    got = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    assert got == wanted_copies(rows, 0.5, 37, 4, mode)
    if mode == "clean":
        per_bin = {r.bin: r["count"] for r in out.filter("bin >= 4").groupBy("bin").count().collect()}
        assert min(per_bin.values()) >= 37


def test_rebalance_rejects_unknown_mode(spark):
    df = spark.createDataFrame([(1, 3.0)], "k bigint, y double")
    with pytest.raises(ValueError):
        rebalance(df, "y", "k", mode="other")


def test_column_profile(spark):
    df = spark.createDataFrame([("null", 1), ("a", 2), ("a", None), ("b", 4)], "t string, n int")
    got = {r.column: r.asDict() for r in column_profile(df).collect()}
    t, n = got["t"], got["n"]
    assert (t["n_rows"], t["n_null_text"], t["n_distinct"], t["min_value"], t["max_value"]) == (4, 1, 3, "a", "null")
    assert (t["top_value"], t["top_count"], t["mean"]) == ("a", 2, None)
    assert (n["n_rows"], n["n_distinct"], n["top_value"]) == (4, 3, "1")
    assert n["mean"] == pytest.approx(7 / 3)
