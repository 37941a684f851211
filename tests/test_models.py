"""Models against closed forms; forests by their properties; jobs end to end."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens import constants as K
from loadlens.__main__ import main
from loadlens.plans import flows, models, prepare
from loadlens.plans.models import Model, fit_forest, fit_linear
from loadlens.sources import tsv


@pytest.fixture(scope="module")
def log(spark):
    """Target depends on a text and a number, so that a model can learn it."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(600):
        g, h, x = f"g{rng.integers(0, 5)}", f"h{rng.integers(0, 3)}", float(rng.uniform(0, 10))
        rows.append((i, g, h, x, 3.0 * int(g[1]) + 0.5 * x + float(rng.normal(0, 0.1))))
    return spark.createDataFrame(rows, f"{K.KEY} bigint, g string, h string, x double, {K.TARGET} double").persist()


def test_linear_on_one_number(log):
    x, y = (np.array(c) for c in zip(*[(r.x, r[K.TARGET]) for r in log.collect()]))
    slope, start = np.polyfit(x, y, 1)
    got = fit_linear(log, ["x"]).predict(log, ["x"]).collect()
    assert np.allclose([r.prediction for r in got], [start + slope * r.x for r in got])


def test_linear_on_one_text_is_the_group_mean(log):
    means = {r.g: r.m for r in log.groupBy("g").agg(F.avg(K.TARGET).alias("m")).collect()}
    got = fit_linear(log, ["g"]).predict(log, ["g"]).distinct().collect()
    assert all(r.prediction == pytest.approx(means[r.g]) for r in got)


def test_unseen_label_keeps_its_row(spark, log):
    model = fit_linear(log, ["g"])
    usual = log.groupBy("g").agg(F.count("*").alias("n"), F.avg(K.TARGET).alias("m")).orderBy(F.desc("n"), "g").first()
    new = spark.createDataFrame([("never",), ("g1",)], "g string")
    got = {r.g: r.prediction for r in model.predict(new).collect()}
    assert got["never"] == pytest.approx(usual.m) and len(got) == 2


@pytest.mark.parametrize("max_labels", [10**6, 6, 0])
def test_long_label_lists_by_join(spark, log, tmp_path, max_labels):
    model = fit_linear(log, ["g", "h", "x"], max_labels=max_labels)
    assert len(model.encoders.joined) == {10**6: 0, 6: 1, 0: 2}[max_labels]
    error = flows.rmse(model.predict(log), K.TARGET, "prediction").first().rmse
    assert error < 0.12
    model.save(str(tmp_path / "m"))
    again = Model.load(spark, str(tmp_path / "m"))
    one = {r[K.KEY]: r.prediction for r in model.predict(log, [K.KEY]).collect()}
    two = {r[K.KEY]: r.prediction for r in again.predict(log, [K.KEY]).collect()}
    assert one == two and len(one) == 600


def test_empty_and_single_labels(spark):
    df = spark.createDataFrame([("", "s", 1.0), ("", "s", 2.0), ("b", "s", 6.0)], f"a string, b string, {K.TARGET} double")
    got = {r.a: r.prediction for r in fit_linear(df, ["a", "b"]).predict(df).collect()}
    assert got[""] == pytest.approx(1.5) and got["b"] == pytest.approx(6.0)


def test_forest_learns_and_repeats(log):
    settings = {"trees": 8, "depth": 100, "rows": 0.9, "columns": "0.6"}
    one, two = (fit_forest(log, ["g", "h", "x"], **settings).predict(log, [K.KEY, K.TARGET]) for _ in range(2))
    assert flows.rmse(one, K.TARGET, "prediction").first().rmse < 1.0 < log.agg(F.stddev_pop(K.TARGET)).first()[0]
    assert one.exceptAll(two).count() == 0


def test_forest_takes_more_labels_than_bins(spark):
    df = spark.range(300).select(F.concat(F.lit("l"), "id").alias("t"), F.col("id").cast("double").alias(K.TARGET))
    model = fit_forest(df, ["t"], trees=2, depth=3, bins=16)
    assert model.predict(df).count() == 300


def test_compare_and_scan(log):
    train, test = log.filter(F.col(K.KEY) % 2 == 0), log.filter(F.col(K.KEY) % 2 == 1)
    got = {r.name: r.rmse for r in flows.compare_features(train, test, {"g": ["g"], "gx": ["g", "x"]}).collect()}
    assert got["gx"] < 0.12 < got["g"]
    scan = flows.add_one_scan(train, test, ["g"])
    assert {r.name for r in scan.collect()} == {"(base)", "h", "x"}


def test_without_key(log):
    got = flows.without_key(log, F.col(K.KEY) % 2 == 0, "g", "g0", {"x": ["x"]}).collect()
    assert [r.train_rows for r in got] == ["all", "without key"] and got[0].n == got[1].n == 300
    assert got[0].rmse != got[1].rmse


def test_segmented_models(log):
    scored = flows.segmented_models(log, ["x"], group_keys=["g"], above=8.0, cap=18.7)
    got = {r.segment: r for r in flows.segment_errors(scored).collect()}
    assert got["pooled"].n == got["fast"].n + got["slow"].n
    total = got["fast"].n * got["fast"].rmse ** 2 + got["slow"].n * got["slow"].rmse ** 2
    assert got["pooled"].rmse == pytest.approx((total / got["pooled"].n) ** 0.5)


def test_segment_without_training_rows(log):
    scored = flows.segmented_models(log, ["x"], group_keys=["g"], above=1e9, cap=18.7)
    assert {r.segment for r in flows.segment_errors(scored).collect()} == {"pooled", "fast"}
    # Every slow row is above the cap: slow test rows would have no model of their own.
    capped = flows.segmented_models(log, ["x"], group_keys=["g"], above=8.0, cap=5.0)
    assert capped.count() == flows.hash_split(log, K.KEY, 0.5)[1].filter(F.col(K.TARGET) < 5.0).count()


def test_rebalanced_forest(log):
    model, scored = flows.rebalanced_forest(log, ["g", "x"], per_bin=40, trees=5, depth=6)
    assert scored.count() == flows.hash_split(log, K.KEY, 0.5)[1].count()


@pytest.mark.parametrize("profile", ["production", "spark"])
def test_jobs(spark, tmp_path, profile):
    raw = {name: F.lit("null") for name in K.RAW_COLUMNS}
    base = spark.range(200).select(F.col("id").alias(K.KEY))
    df = base.withColumns(raw).withColumns(
        {
            K.TARGET: (F.col(K.KEY) % 17).cast("string"),
            "PLACEMENTID": (F.col(K.KEY) % 17).cast("string"),
            "TIMESTAMP": (F.col(K.KEY) + 1458500001).cast("string"),
            "FILESJSON": F.lit('[{"type":"image","size":3}]'),
        }
    )
    log, saved, out = (str(tmp_path / n) for n in ("log", "model", "out"))
    tsv.write_tsv(df, log)
    small = {"trees": 3, "depth": 5}
    report = flows.train_job(spark, log, saved, valid_path=log, profile=profile, forest=small)
    values = np.arange(200) % 17
    kept = int((values < np.percentile(values, K.TRIM_VALIDATION)).sum())
    assert report.error.first().n == kept and report.profile.count() > 10
    # The histogram reaches the largest value: no row is left out.
    counted = report.histogram.agg(F.sum(f"n_{K.TARGET.lower()}"), F.sum("n_prediction")).first()
    assert tuple(counted) == (kept, kept)
    # Scoring needs no target and loses no row.
    bare = str(tmp_path / "bare")
    tsv.write_tsv(df.withColumn(K.TARGET, F.lit("null")), bare)
    scored = flows.apply_job(spark, bare, saved, out, profile=profile, shift=K.SCORE_SHIFT)
    assert scored.count() == 200 and tsv.read_tsv(spark, out).count() == 200
    plain = flows.apply_job(spark, bare, saved, profile=profile)
    main(["apply", bare, saved, out + "2", "--profile", profile])
    assert tsv.read_tsv(spark, out + "2").count() == 200
    gap = scored.withColumnRenamed("prediction", "s").join(plain, K.KEY).select(F.col("s") - F.col("prediction"))
    assert all(g[0] == pytest.approx(0.3) for g in gap.collect())


def test_feature_sets_exist(spark):
    df = spark.range(1).select(*[F.lit("null").alias(n) for n in K.RAW_COLUMNS], F.col("id").alias(K.KEY))
    made = set(prepare.prepare(df, "production").columns)
    assert made.issuperset(K.FEATURES_RF) and made.issuperset(K.FEATURES_RF_LITE)
    assert set(prepare.prepare(df, "spark").columns).issuperset(K.FEATURES_SPARK)
    explored = set(prepare.explore(df, 100, 100).columns)
    assert explored.issuperset(K.FEATURES_LR) and explored.issuperset(K.FEATURES_LR_SECOND_BASE)
    assert not explored & set(K.EXPLORE_DROPPED)
    assert len(K.RAW_COLUMNS) == 47 and models.MAX_DEPTH == 30


@pytest.mark.parametrize("fit", [lambda d, f: fit_linear(d, f), lambda d, f: fit_forest(d, f, trees=3, depth=3)])
def test_malformed_numbers_and_missing_texts(log, fit):
    df = log.withColumn("x", F.when(F.col(K.KEY) % 7 == 0, None).when(F.col(K.KEY) % 7 == 1, float("nan")).otherwise(F.col("x")))
    df = df.withColumn("g", F.when(F.col(K.KEY) % 5 == 0, None).otherwise(F.col("g")))
    df = df.withColumn(K.TARGET, F.when(F.col(K.KEY) % 11 == 0, float("nan")).otherwise(F.col(K.TARGET)))
    scored = fit(df, ["g", "x"]).predict(df, [K.KEY, "g"])
    assert scored.count() == 600 and scored.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0
    assert scored.filter("g is null").count() == 120
    counts = models.missing_counts(df, ["g", "x"]).first()
    assert (counts.n, counts.missing_x, counts[f"missing_{K.TARGET.lower()}"]) == (600, 172, 55)


def test_a_missing_text_is_a_label_of_its_own(spark):
    df = spark.createDataFrame([(None, 1.0)] * 10 + [("a", 5.0)] * 30 + [("b", 9.0)] * 20, f"g string, {K.TARGET} double")
    for most in (2000, 0):
        got = {r.g: r.prediction for r in fit_linear(df, ["g"], max_labels=most).predict(df, ["g"]).distinct().collect()}
        assert got == {None: pytest.approx(1.0), "a": pytest.approx(5.0), "b": pytest.approx(9.0)}


def test_forest_does_not_depend_on_the_layout(log):
    def predictions(rows):
        model = fit_forest(rows, ["g", "x"], trees=4, depth=4)
        return {r[0]: r[1] for r in model.predict(log, [K.KEY]).collect()}

    assert predictions(log.repartition(3)) == predictions(log.repartition(11).orderBy(F.desc("x")))


def test_depth_beyond_the_limit_is_told(log):
    with pytest.warns(UserWarning, match="depth 50"):
        model = fit_forest(log, ["x"], trees=1, depth=50)
    assert model.about["depth"] == 30 and model.about["wanted_depth"] == 50
