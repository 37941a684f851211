"""Deep forests: against a brute force, against pyspark.ml, and piece by piece."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from loadlens import constants as K
from loadlens.operators import deep_forest
from loadlens.operators.split import hash_split
from loadlens.plans import flows, models
from loadlens.plans.models import Model, fit_forest


@pytest.fixture(scope="module")
def log(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        g, x, z = f"g{rng.integers(0, 6)}", round(float(rng.uniform(0, 10)), 2), float(rng.integers(0, 4))
        rows.append((i, g, x, z, 2.0 * int(g[1]) + x + x * z / 3 + float(rng.normal(0, 1))))
    return spark.createDataFrame(rows, f"{K.KEY} bigint, g string, x double, z double, {K.TARGET} double").persist()


def predictions(model, df):
    return {r[0]: r[1] for r in model.predict(df, [K.KEY]).collect()}


def brute(x, y, depth):
    """Predictions of a tree on its own rows that tries every threshold of every feature."""
    best = (1e-9, None)
    for f in range(x.shape[1] if depth else 0):
        for t in sorted(set(x[:, f]))[:-1]:
            low = x[:, f] <= t
            gain = low.sum() * (~low).sum() / len(y) * (y[low].mean() - y[~low].mean()) ** 2
            if gain > best[0]:
                best = (gain, low)
    out = np.full(len(y), y.mean())
    if best[1] is not None:
        for side in (best[1], ~best[1]):
            out[side] = brute(x[side], y[side], depth - 1)
    return out


@pytest.mark.parametrize(("small", "depth"), [(10**6, 30), (40, 11)])
def test_a_tree_is_the_greedy_one(spark, monkeypatch, small, depth):
    monkeypatch.setattr(deep_forest, "SMALL_NODE", small)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (200, 3)).astype(float)
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], f"{K.KEY} bigint, a double, b double, c double, {K.TARGET} double")
    got = predictions(fit_forest(df, ["a", "b", "c"], trees=1, depth=depth), df)
    assert np.allclose([got[i] for i in range(200)], brute(x, y, depth), atol=1e-7)


def test_parts_of_a_tree_make_the_same_tree(log, monkeypatch):
    settings = {"trees": 5, "depth": 14, "columns": "0.6", "bins": 64}
    whole = predictions(fit_forest(log, ["g", "x", "z"], **settings), log)
    monkeypatch.setattr(deep_forest, "SMALL_NODE", 100)
    model = fit_forest(log.repartition(7).orderBy(F.desc("x")), ["g", "x", "z"], **settings)
    split = predictions(model, log)
    assert split.keys() == whole.keys() and np.allclose([split[k] for k in whole], list(whole.values()), atol=1e-7)
    # No task grows more than a small node, and the driver holds the upper nodes only.
    sizes = [len(r.data) // deep_forest._NODE.itemsize for r in model.forest.pieces.collect()]
    assert max(sizes) < 200 and len(model.forest.top) < sum(sizes) / 5


def test_full_size_forests_leave_the_learner(log):
    """The learner holds arrays per node and all nodes in the driver; with a leaf per row both grow with the rows."""
    model = fit_forest(log, ["g", "x", "z"], **K.FOREST_SPARK)
    assert not any(isinstance(s, RandomForestRegressionModel) for s in model.stages.stages)
    assert model.about["trees"] == 50 and model.about["depth"] == 25
    nodes = [np.frombuffer(r.data, deep_forest._NODE) for r in model.forest.pieces.collect()]
    # Few trees end early, where the one feature that a node tries has a single value.
    assert len(nodes) == 50 and sum(len(n) for n in nodes) > 50 * 100


@pytest.mark.parametrize("settings", [K.FOREST_SPARK, K.FOREST_TRAIN, K.FOREST_EXPLORE], ids=["spark", "train", "explore"])
def test_as_good_as_the_learner(log, monkeypatch, settings):
    train, test = hash_split(log, K.KEY, 0.5)
    error = lambda: flows.rmse(fit_forest(train, ["g", "x", "z"], **settings | {"trees": 10, "depth": 12}).predict(test), K.TARGET, "prediction").first().rmse
    ours = error()
    monkeypatch.setattr(models, "SHALLOW", 99)
    assert ours == pytest.approx(error(), rel=0.15)


def test_bags_are_poisson_draws():
    for rate in (0.5, 0.9, 1.0):
        drawn = deep_forest._draws(np.arange(20_000), deep_forest.Settings(20, 25, 16, rate, 1, 1))
        assert drawn.mean() == pytest.approx(rate, abs=0.01) and drawn.var() == pytest.approx(rate, abs=0.02)
        assert abs(np.corrcoef(drawn[:, 0], drawn[:, 1])[0, 1]) < 0.03


def test_names_of_subsets():
    names = ["auto", "all", "onethird", "sqrt", "log2", "0.6", "4"]
    assert [deep_forest.subset_size(c, 17, 50) for c in names] == [6, 17, 6, 5, 5, 11, 4]
    assert deep_forest.subset_size("auto", 17, 1) == 17


def test_odd_rows(spark):
    rows = [(i, None if i % 5 == 0 else f"t{i % 3}", [None, float("nan"), 1.0, 2.0][i % 4], None if i % 7 == 0 else 4.0 + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows * 2, f"{K.KEY} bigint, t string, x double, {K.TARGET} double")
    for part in (df, df.limit(0).union(df.filter(f"{K.KEY} = 1"))):
        got = fit_forest(part, ["t", "x"], trees=4, depth=20, rows=0.5).predict(df).collect()
        assert len(got) == 120 and all(4.0 <= r.prediction <= 5.0 for r in got)
    equal = fit_forest(df.withColumn(K.TARGET, F.lit(3.25)), ["t", "x"], trees=3, depth=20)
    assert {r.prediction for r in equal.predict(df.filter("x is null or t = 't1'")).collect()} == {3.25}


def test_thresholds_of_many_values_are_even(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id")).cast("double").alias("x0"), (F.col("id") % 3).cast("double").alias("x1"), F.lit(1.0).alias("x2"))
    edges = deep_forest._edges(df.repartition(5), 3, 50)
    assert edges[1:] == [[0.5, 1.5], []]
    assert np.diff(np.sqrt([-1, *edges[0], 4999.0**2][1:])).tolist() == [100.0] * 49 and len(edges[0]) == 49


def test_saved_deep_forest(spark, log, tmp_path):
    model = fit_forest(log, ["g", "x"], trees=3, depth=15, max_labels=2)
    model.save(str(tmp_path / "m"))
    assert predictions(Model.load(spark, str(tmp_path / "m")), log) == predictions(model, log)


def test_segments_and_rebalanced_rows_with_deep_forests(log):
    deep = {"trees": 4, "depth": 20, "rows": 0.5}
    fit = lambda rows, names: fit_forest(rows, names, **deep)
    scored = flows.segmented_models(log, ["g", "x"], group_keys=["g"], above=10.0, cap=18.0, fit_fast=fit, fit_slow=fit)
    n = hash_split(log, K.KEY, 0.5)[1].filter(F.col(K.TARGET) < 18.0).count()
    assert scored.count() == n == scored.filter("prediction is not null").count()
    model, scored = flows.rebalanced_forest(log, ["g", "x"], per_bin=40, **deep)
    assert model.forest is not None and scored.count() == hash_split(log, K.KEY, 0.5)[1].count()


def test_only_nodes_of_several_values_are_searched(monkeypatch):
    """Leaves of one value were searched for a split as the other nodes are."""
    rng = np.random.default_rng(2)
    x, w = rng.integers(0, 50, (2000, 4)).astype("<u2"), np.ones(2000)
    y = (x[:, 0] > 30).astype(float)
    searched, real = [], deep_forest._subsets
    monkeypatch.setattr(deep_forest, "_subsets", lambda trees, nodes, *more: searched.extend(nodes) or real(trees, nodes, *more))
    nodes = deep_forest._grow(x, y, y * w, w, 1, 1, deep_forest.Settings(1, 30, 64, 1.0, 2, 1))
    inner = nodes["feature"] >= 0
    assert inner.any() and set(nodes["value"][~inner]) == {0.0, 1.0}
    assert len(searched) == inner.sum() < len(nodes)
