"""Counting search against numpy, with hot groups and awkward values."""

import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlens.functions.bins import nearest_edge
from loadlens.operators import ranks
from loadlens.operators.groups import encode_labels, group_means, group_spread, label_index
from loadlens.operators.histogram import edges_for
from loadlens.operators.rebalance import rebalance

AWKWARD = {
    "skewed": np.random.default_rng(1).lognormal(2, 1.5, 4000),
    "one value": np.full(500, 3.25),
    "mostly one value": np.concatenate([np.zeros(3000), np.random.default_rng(2).normal(0, 1, 1000)]),
    "tiny": np.random.default_rng(3).uniform(0, 1e-9, 1000),
    "wide": np.concatenate([-(10.0 ** np.arange(-10, 200, 7)), 10.0 ** np.arange(-10, 200, 7)]),
    "single": np.array([5.0]),
}


@pytest.mark.parametrize("name", AWKWARD)
def test_percentiles(spark, name):
    x = AWKWARD[name]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    percents = [0, 5, 50, 94.4, 95.25, 99, 100]
    assert np.allclose(ranks.percentiles(df, "x", percents), np.percentile(x, percents), rtol=1e-12, atol=0)


def test_percentiles_skip_missing(spark):
    df = spark.createDataFrame([(None,), (1.0,), (float("nan"),), (3.0,)], "x double")
    assert ranks.percentiles(df, "x", [50]) == [2.0]
    assert ranks.percentiles(df.filter("x > 100 and not isnan(x)"), "x", [50]) == [None]


@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40), st.floats(0, 100))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_percentile_of_any_list(spark, numbers, percent):
    df = spark.createDataFrame([(v,) for v in numbers], "x double")
    (got,) = ranks.percentiles(df, "x", [percent])
    assert np.isclose(got, np.percentile(numbers, percent), rtol=1e-9, atol=1e-9)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows in one group, the rest in many small ones."""
    rng = np.random.default_rng(5)
    n = 6000
    group = np.where(rng.random(n) < 0.34, "hot", np.char.add("g", rng.integers(0, 300, n).astype(str)))
    value = np.round(rng.lognormal(1, 1, n), 3)
    rows = [(int(i), str(g), float(v)) for i, g, v in zip(rng.permutation(n), group, value)]
    return spark.createDataFrame(rows, "k bigint, g string, v double").repartition(6).persist(), rows


@pytest.mark.parametrize("small", [10**9, 100, 1])
def test_group_spread(hot, small):
    df, rows = hot
    by = {}
    for _, g, v in rows:
        by.setdefault(g, []).append(v)
    got = {r["g"]: r for r in group_spread(df, ["g"], "v", small=small).collect()}
    assert got.keys() == by.keys()
    for g, v in by.items():
        assert got[g]["n"] == len(v)
        assert np.isclose(got[g]["median"], np.median(v), rtol=1e-12)
        assert np.isclose(got[g]["std"], np.std(v))
        assert np.isclose(got[g]["mean"], np.mean(v))


def test_spread_variants(hot):
    df, rows = hot
    v = [r[2] for r in rows if r[1] == "hot"]
    sample = group_spread(df, ["g"], "v", ddof=1).filter("g = 'hot'").first()
    assert np.isclose(sample["std"], np.std(v, ddof=1))
    rough = group_spread(df, ["g"], "v", approximate=True).filter("g = 'hot'").first()
    assert abs(rough["median"] - np.median(v)) < 0.01


@pytest.mark.parametrize("small", [10**9, 50])
def test_first_rows(hot, small):
    df, rows = hot
    got = sorted((r["g"], r["k"]) for r in ranks.first_rows(df, ["g"], "k", 4, small=small).collect())
    by = {}
    for k, g, _ in rows:
        by.setdefault(g, []).append(k)
    assert got == sorted((g, k) for g, ks in by.items() for k in sorted(ks)[:4])


def test_values_at_ranks_of_big_integers(spark):
    base = 2**62
    rows = [("a", base + i * i) for i in range(300)] + [("b", -base + i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k bigint")
    targets = spark.createDataFrame([("a", 17), ("a", 299), ("b", 0)], "g string, _rank bigint")
    got = sorted(tuple(r) for r in ranks.values_at_ranks(df, ["g"], "k", targets).collect())
    assert got == [("a", 17, base + 17 * 17), ("a", 299, base + 299 * 299), ("b", 0, -base)]


def test_label_index(spark):
    rows = [("a",)] * 3 + [("c",)] * 2 + [("b",)] * 2 + [("",)]
    df = spark.createDataFrame(rows, "x string").withColumn("y", F.lit("one"))
    got = {(r["feature"], r["label"]): r["idx"] for r in label_index(df, ["x", "y"]).collect()}
    assert got == {("x", "a"): 0, ("x", "b"): 1, ("x", "c"): 2, ("x", ""): 3, ("y", "one"): 0}


def test_label_index_over_many_partitions(spark):
    labels = [f"l{i:04d}" for i in range(2000)]
    df = spark.createDataFrame([(v,) for i, v in enumerate(labels) for _ in range(1 + i % 3)], "x string")
    want = sorted(labels, key=lambda v: (-(1 + int(v[1:]) % 3), v))
    index = label_index(df, ["x"])
    assert [r["label"] for r in index.orderBy("idx").collect()] == want
    assert index.agg(F.max("idx")).first()[0] == 1999
    looked_up = encode_labels(spark.createDataFrame([("l0002",), ("new",)], "x string"), "x", index, "i")
    assert {r["x"]: r["i"] for r in looked_up.collect()} == {"l0002": 0, "new": None}


def test_group_means(spark):
    df = spark.createDataFrame([("a", "p", 1.0), ("a", "q", 3.0), ("b", "q", 5.0)], "x string, y string, v double")
    got = {(r["feature"], r["level"]): (r["n"], r["mean"]) for r in group_means(df, ["x", "y"], "v").collect()}
    assert got == {("x", "a"): (2, 2.0), ("x", "b"): (1, 5.0), ("y", "p"): (1, 1.0), ("y", "q"): (2, 4.0)}


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)"])
def test_same_answer_on_both_sides_of_the_size_limit(spark, kind):
    nan, inf = float("nan"), float("inf")
    values = {"a": [1.0, 5.0, 2.5, None] + [nan] * 7, "b": [nan, nan], None: [3.0, 9.0], "c": [4.0, inf] if kind == "double" else [4.0], "d": [None]}
    rows = [(k, v) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    if kind != "double":
        df = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")).cast(kind))
    spread = [sorted(map(repr, group_spread(df, ["k"], "v", small=small).select("k", "n", "mean", "median").collect())) for small in (0, 10**9)]
    assert spread[0] == spread[1] and len(spread[0]) == 5
    quantile = [sorted(map(repr, ranks.group_quantile(df, ["k"], "v", 0.3, small=small).collect())) for small in (0, 10**9)]
    assert quantile[0] == quantile[1]
    by_key = {r.k: r for r in group_spread(df, ["k"], "v", small=0).collect()}
    assert (by_key["a"].n, by_key["a"].median, by_key["b"].n, by_key["b"].median, by_key[None].median) == (3, 2.5, 0, None, 6.0)
    assert ranks.percentiles(df.where("k <> 'c'"), "v", [50])[0] == 2.5


def test_first_rows_of_null_and_large_groups(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([None, "x"] * 20)], "k string, i long")
    for small in (1, 10**9):
        assert sorted(r.i for r in ranks.first_rows(df, ["k"], "i", 3, small=small).collect()) == list(range(6))


def test_missing_values_have_no_bin(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, 0.2), (2, None), (3, nan), (4, 7.6), (5, inf)], "i long, v double")
    assert edges_for(df, "v", 1.0) == 8
    bins = {r.i: r.b for r in df.select("i", nearest_edge(F.col("v"), 1.0, 8).alias("b")).collect()}
    assert bins == {1: 0, 2: None, 3: None, 4: 7, 5: 7}
    assert {r.i for r in rebalance(df, "v", "i", 1.0, 2, 0, "clean").collect()} == {1, 4, 5}


def test_short_groups_are_ordered_without_a_sketch(spark):
    """Nearly a group per row: one grouping, no sketch, no search and no join; long groups beside them keep theirs."""
    rows = [(i // 2, float(i % 7) if i % 5 else None) for i in range(600)]
    short = spark.createDataFrame(rows, "g long, v double")
    found = group_spread(short, ["g"], "v", many=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "kll" not in plan and "join" not in plan
    both = group_spread(short.unionByName(spark.range(5000).selectExpr("-1 as g", "cast(id as double) as v")), ["g"], "v", many=True)
    for df, extra in ((found, {}), (both, {-1: [float(i) for i in range(5000)]})):
        values = {g: [v for k, v in rows if k == g and v is not None] for g in range(300)} | extra
        got = {r.g: r for r in df.collect()}
        assert got.keys() == values.keys()
        for g, v in values.items():
            assert got[g].n == len(v) and got[g].median == (statistics.median(v) if v else None)
