"""Passes over the data, hot keys, sketches that miss, missing values: what only shows at size."""

import io
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens import constants as K
from loadlens import session
from loadlens.operators import evaluate, groups, histogram, measures, profile, ranks, rebalance, segments, split
from loadlens.plans import flows, models
from loadlens.sources import tsv


def watched(df):
    """``df`` with a counter of the rows that are read from it."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), seen


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    rows = [(str(g), float(v)) for g, v in zip(rng.choice(["hot", "a", "b", "c"], 9_000, p=[0.9, 0.05, 0.04, 0.01]), np.round(rng.lognormal(2, 1, 9_000), 2))]
    return spark.createDataFrame(rows, "g string, v double").repartition(5).persist(), rows


@pytest.mark.parametrize("margin", [0.02, 0.0])  # without a margin brackets hold a value or two, and some ranks fall outside
@pytest.mark.parametrize("small", [10**9, 3])
def test_quantiles_are_exact_whatever_the_sketch_says(numbers, monkeypatch, margin, small):
    df, rows = numbers
    monkeypatch.setattr(ranks, "_MARGIN", margin)
    monkeypatch.setattr(ranks, "_SKETCH", 16 if margin == 0 else 1_024)
    for q in (0.0, 0.3, 0.5, 0.999, 1.0):
        got = {r.g: r._quantile for r in ranks.group_quantile(df, ["g"], "v", q, small=small).collect()}
        for g in ("hot", "a", "b", "c"):
            assert got[g] == pytest.approx(np.quantile([v for k, v in rows if k == g], q), rel=1e-12)
    percents = [0, 1, 50, 50.5, 95.25, 100]
    assert np.allclose(ranks.percentiles(df, "v", percents), np.percentile([v for _, v in rows], percents), rtol=1e-12)


def test_quantiles_read_the_rows_twice(numbers):
    df, seen = watched(numbers[0])
    groups.group_spread(df, ["g"], "v").collect()
    assert seen.value == 18_000
    df, seen = watched(numbers[0])
    ranks.percentiles(df, "v", [50, 95])
    assert seen.value == 18_000


def test_exact_samples_do_not_depend_on_the_layout(spark):
    base = spark.range(20_000).withColumnRenamed("id", "k")
    picks = [sorted(r.k for r in split.exact_sample(base.repartition(n), "k", 777, seed=5).collect()) for n in (1, 4, 64)]
    assert len(picks[0]) == 777 and picks[0] == picks[1] == picks[2]
    assert picks[0] != sorted(r.k for r in split.exact_sample(base, "k", 777, seed=6).collect())
    one, two = split.exact_halves(base, "k", 0.25)
    assert (one.count(), two.count(), one.intersect(two).count()) == (5_000, 15_000, 0)
    assert split.exact_sample(base, "k", 10**6).count() == 20_000
    assert split.exact_sample(base, "k", 0).count() == 0 and split.exact_sample(base.limit(0), "k", 5).count() == 0


def test_a_hot_label_is_not_shuffled_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 100)
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 2_000).cast("string"))).alias("x"))
    rows = rows.withColumn("x", F.when(F.col("id") == 17, None).otherwise(F.col("x")))
    index = session.cut_lineage(groups.label_index(rows, ["x"]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = groups.encode_labels(rows, "x", index, "i").withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    places = {r.label: r.idx for r in index.collect()}
    assert len(found) == 20_000 and all(r.i == places.get(r.x or "") for r in found)
    sizes = np.bincount([r.part for r in found], minlength=16)
    assert sizes.max() <= 3 * np.median(sizes)


def test_very_many_copies_of_one_row(spark):
    df = spark.createDataFrame([(1, 10**6), (2, 3), (3, 0), (4, 1_000), (5, 1_001)], "k long, n long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = rebalance.copied(df, F.col("n"), "k", 10**6)
        assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == {1: 10**6, 2: 3, 4: 1_000, 5: 1_001}
        shares = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(shares) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(shares) < 0.5 * 10**6
        assert out.columns == ["k", "n"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def write(folder, name, text):
    (folder / name).write_text(text)


def test_files_with_other_headers_are_aligned(spark, tmp_path):
    write(tmp_path, "one.tsv", "A\tB\tC\n1\t2\t3\nA\tB\tC\n\t5\t\n")
    write(tmp_path, "two.tsv", "B\tD\tA\n20\t40\t10\n21\n22\t42\t12\tmore\n")
    write(tmp_path, "six.tsv", "A\tB\tC\n7\t8\t9\n")
    found = tsv.read_aligned(spark, str(tmp_path))
    assert found.columns == ["A", "B", "C", "D"]
    want = [("1", "2", "3", ""), ("", "5", "", ""), ("7", "8", "9", ""), ("10", "20", "", "40"), ("", "21", "", ""), ("12", "22", "", "42")]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert sorted(r.D for r in tsv.read_aligned(spark, str(tmp_path), ["D", "Z"]).collect()) == ["", "", "", "", "40", "42"]
    report = tsv.header_report(spark, str(tmp_path), ["A", "B", "C"]).where("not known").collect()
    assert [(r.file.rsplit("/")[-1], r.position, r.column) for r in report] == [("two.tsv", 1, "D")]


def test_the_reader_parses_only_what_is_asked_for(spark, tmp_path):
    names = [f"C{i}" for i in range(12)]
    write(tmp_path, "one.tsv", "\t".join(names) + "\n" + "\t".join("x" * 12) + "\n" + "\t".join(names) + "\n")
    df = tsv.read_tsv(spark, str(tmp_path)).select("C9")
    assert [r.C9 for r in df.collect()] == ["x"]
    (schema,) = [line for line in plan_of(df).splitlines() if line.startswith("ReadSchema")]
    assert schema.count(":string") == tsv.HEADER_FIELDS + 1


def test_all_measures_equal_the_single_ones(spark):
    rng = np.random.default_rng(4)
    y = [*np.round(rng.exponential(8, 500), 1).tolist(), 0.0, 10.0, 40.0, 60.0, -3.0, None, float("nan"), 7.0, 7.0, 60.0]
    p = [*np.round(rng.exponential(8, 500), 1).tolist(), 0.0, 10.0, 44.0, 60.0, 2.0, 1.0, 2.0, None, float("nan"), 59.0]
    df, seen = watched(spark.createDataFrame(list(zip(y, p)), "y double, p double").repartition(3))
    found = measures.measure(df, "y", "p", 10.0)
    parts = [sorted(map(tuple, x.collect())) for x in (found.error, found.histogram, found.profile)]
    assert seen.value == 510
    edges = max(histogram.edges_for(df, c, 10.0) for c in "yp") + 1
    assert parts[0][0][0] == 506 and parts[0][0][1] == pytest.approx(evaluate.rmse(df, "y", "p").first().rmse)
    assert parts[1] == sorted(map(tuple, histogram.histogram(df, ["y", "p"], 10.0, edges=edges).collect()))
    single = sorted(map(tuple, histogram.error_profile(df, "y", "p", 10.0).collect()))
    assert [r[:3] for r in parts[2]] == [r[:3] for r in single]
    assert [r[3] for r in parts[2]] == pytest.approx([r[3] for r in single], nan_ok=True)
    fixed = measures.measure(df, "y", "p", 10.0, upper=45.0)
    assert sorted(map(tuple, fixed.histogram.collect())) == sorted(map(tuple, histogram.histogram(df, ["y", "p"], 10.0, edges=5).collect()))
    empty = measures.measure(df.limit(0), "y", "p", 10.0)
    assert (empty.error.first().n, empty.error.first().rmse, empty.profile.count()) == (0, None, 0)


def test_jobs_parse_a_log_once_and_count_on_the_way(spark, tmp_path):
    rows = spark.range(300).select(F.col("id").alias(K.KEY), F.when(F.col("id") % 10 == 0, "null").when(F.col("id") % 25 == 1, "bad").otherwise((F.col("id") % 50).cast("string")).alias(K.TARGET), (F.col("id") % 5).cast("string").alias("PLACEMENTID"))
    log, saved = str(tmp_path / "log"), str(tmp_path / "model")
    tsv.write_tsv(rows, log)
    report = flows.train_job(spark, log, saved, trim=90.0, features=["PLACEMENTID"], forest={"trees": 2, "depth": 3})
    (row,) = report.counts.collect()
    values = [0 if i % 10 == 0 else i % 50 for i in range(300) if i % 10 == 0 or i % 25 != 1]
    assert (row.file, row.n_rows, row.n_imputed, row.n_malformed) == ("train", 300, 30, 300 - len(values))
    assert row.n_kept == sum(v < np.percentile(values, 90) for v in values) == report.error.first().n
    done = flows.score_job(spark, log, saved, str(tmp_path / "out"))
    assert tuple(done.counts.first()) == (300, 300) and done.histogram.agg(F.sum("n_prediction")).first()[0] == 300


def test_missing_values_mean_the_same_everywhere(spark):
    nan = float("nan")
    rows = [(None, "a", True, 1.0, 2.0), (1, None, None, nan, 1.0), (2, None, False, 9.0, nan), (3, "a", True, None, 4.0), (4, "b", None, 50.0, 40.0), (5, None, True, 60.0, None)]
    df = spark.createDataFrame(rows, "id long, g string, flag boolean, y double, p double")
    assert sum(x.count() for x in split.hash_split(df, "id")) == 6
    assert [x.count() for x in segments.split_by_flag(df, "flag")] == [3, 3]
    slow = segments.slow_groups(df, "y", ["g"], 20.0)  # the NULL group (9, 60) and b
    assert sorted(r.g or "" for r in slow.collect()) == ["", "b"]
    assert (segments.rows_in(df, slow, ["g"]).count(), segments.rows_not_in(df, slow, ["g"]).count()) == (4, 2)
    assert segments.flag_rows(df, slow, ["g"]).where("is_slow").count() == 4
    assert segments.rows_in(df, slow, ["g"]).columns == df.columns
    assert tuple(evaluate.rmse(df, "y", "p").first()) == (2, pytest.approx(np.sqrt((1 + 100) / 2)))
    assert tuple(evaluate.baseline_rmse(df, "y").first())[:2] == (4, 30.0)
    means = {r.level: (r.n, r["mean"]) for r in groups.group_means(df, ["g"], "y").collect()}
    assert means == {"a": (1, 1.0), "b": (1, 50.0), None: (2, 34.5)}
    near = {r.bin: (r.n, r.mean_abs_error) for r in histogram.error_profile(df, "y", "p", 10.0).collect() if r.n}
    assert near == {0: (1, 1.0), 5: (1, 10.0)}
    (row,) = profile.column_profile(df.select("y")).collect()
    assert row["mean"] == 30.0
    scored = flows.segmented_models(df.withColumns({K.KEY: F.col("id"), K.TARGET: F.col("y")}), ["p"], group_keys=["g"], above=20.0, cap=1e9, share=1.0 - 1e-9)
    assert scored.count() >= 0
    model = models.fit_linear(df.withColumnRenamed("y", K.TARGET), ["g"])
    assert model.predict(df, ["id"]).count() == 6


def test_sketch_profile(spark):
    rng = np.random.default_rng(6)
    rows = [(f"v{i}", str(int(rng.integers(0, 50))), "null", float(rng.normal()), None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "a string, b string, c string, x double, e string").repartition(4)
    found = profile.sketch_profile(df)
    assert "c0" not in " ".join(line for line in plan_of(found).splitlines() if "hashpartitioning" in line)
    rough, exact = ({r.column: r for r in x.collect()} for x in (found, profile.column_profile(df)))
    x = np.sort([r[3] for r in rows])
    for c, r in rough.items():
        assert (r.n_rows, r.n_null_text, r.min_value, r.max_value) == (20_000, exact[c].n_null_text, exact[c].min_value, exact[c].max_value)
        assert abs(r.n_distinct - exact[c].n_distinct) <= profile.DISTINCT_BOUND * exact[c].n_distinct + 0.5
    assert rough["b"].top_value == exact["b"].top_value and rough["b"].top_count == exact["b"].top_count
    for q, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
        assert abs(np.searchsorted(x, rough["x"][name]) / 20_000 - q) <= profile.QUANTILE_BOUND
    assert rough["a"]["median"] is None and rough["e"].top_value is None
    assert rough["x"]["mean"] == pytest.approx(exact["x"]["mean"]) and rough["x"]["std"] == pytest.approx(exact["x"]["std"])
