"""Experiments and jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadlens import constants as K
from loadlens.functions.cleaning import as_double
from loadlens.operators.descent import block_fits
from loadlens.operators.evaluate import error_of, rmse, rmse_of, shifted
from loadlens.operators.measures import measure
from loadlens.operators.products import MAX_SUMS, fits
from loadlens.operators.rebalance import rebalance
from loadlens.operators.segments import flag_rows, slow_groups, split_by_flag
from loadlens.operators.split import hash_split
from loadlens.operators.trim import cap_below, keep_below, percentile_limit
from loadlens.plans.models import Model, fit_encoders, fit_forest, fit_linear, text_features
from loadlens.plans.prepare import prepare
from loadlens.session import cut_lineage, scratch_path
from loadlens.sources.tsv import read_tsv, write_predictions

Fit = Callable[[DataFrame, list[str]], Model]


def compare_lists(
    df: DataFrame,
    train: Column,
    sets: dict[str, list[str]],
    target: str = K.TARGET,
    iterations: int = 100,
    max_sums: int = MAX_SUMS,
) -> DataFrame:
    """Test error of one linear model per named feature list: ``name``, ``n``, ``rmse``.

    The rows are read once: all models are solved from shared sums of products.
    Where these are too many (label pairs without end), the models are solved in
    steps over blocks of rows; lists of so many numbers are fitted by the learner. Rows of which ``train`` is NULL are not used.
    """
    found = fits(df, train, target, sets, max_sums, block_fits)
    if found is not None:
        return found.select("name", "n", "rmse")
    return _compare_by_learner(df.filter(train), df.filter(~train), sets, target, iterations)


def compare_features(
    train: DataFrame, test: DataFrame, sets: dict[str, list[str]], target: str = K.TARGET, iterations: int = 100, max_sums: int = MAX_SUMS
) -> DataFrame:
    """``compare_lists`` over two frames."""
    needed = [target, *dict.fromkeys(c for features in sets.values() for c in features)]
    halves = [part.select(*needed, F.lit(flag).alias("_train")) for part, flag in ((train, True), (test, False))]
    return compare_lists(halves[0].unionByName(halves[1]), F.col("_train"), sets, target, iterations, max_sums)


def _compare_by_learner(train: DataFrame, test: DataFrame, sets: dict[str, list[str]], target: str, iterations: int) -> DataFrame:
    """One learner run per list. Labels are counted and indexed once for all lists."""
    needed = list(dict.fromkeys(c for features in sets.values() for c in features))
    encoders = fit_encoders(train, text_features(train, needed))
    halves = [encoders.index(half.select(target, *needed)) for half in (train, test)]
    # The text stays only as empty columns, so that a feature keeps its name and type.
    texts = set(encoders.sizes)
    keep = [target, *[c for c in needed if c not in texts], *[f"_{c}" for c in texts]]
    train, test = (h.select(*keep, *[F.lit("").alias(c) for c in texts]).persist() for h in halves)
    try:
        rows = []
        for name, features in sets.items():
            model = fit_linear(train, features, target, iterations, indexed=encoders)
            n, error = rmse(model.predict(test, keep=[target]), target, "prediction").first()
            rows.append((name, n, error))
    finally:
        train.unpersist()
        test.unpersist()
    return train.sparkSession.createDataFrame(rows, "name string, n bigint, rmse double")


def add_one_sets(columns: list[str], base: list[str], skip: tuple[str, ...] = (K.KEY, K.TARGET)) -> dict[str, list[str]]:
    """The base list, and one list with each remaining column added."""
    sets = {"(base)": base} if base else {}
    return sets | {c: [*base, c] for c in columns if c not in (*skip, *base)}


def add_one_scan(
    train: DataFrame,
    test: DataFrame,
    base: list[str],
    candidates: list[str] | None = None,
    target: str = K.TARGET,
    skip: tuple[str, ...] = (K.KEY,),
    iterations: int = 50,
) -> DataFrame:
    """Test error of ``base`` alone and with each other column added."""
    sets = add_one_sets(train.columns if candidates is None else candidates, base, (target, *skip))
    return compare_features(train, test, sets, target, iterations)


def without_key(df: DataFrame, train: Column, column: str, unwanted: str, sets: dict[str, list[str]], target: str = K.TARGET) -> DataFrame:
    """Compare training with and without the rows of one key; the test rows stay the same."""
    every = compare_lists(df, train, sets, target).withColumn("train_rows", F.lit("all"))
    dropped = train & F.col(column).eqNullSafe(unwanted)
    fewer = compare_lists(df, F.when(~dropped, train), sets, target)
    return every.unionByName(fewer.withColumn("train_rows", F.lit("without key")))


def segmented_models(
    df: DataFrame,
    features: list[str],
    key: str = K.KEY,
    target: str = K.TARGET,
    group_keys: list[str] = K.SEGMENT_KEYS,
    above: float = K.SLOW_MEDIAN,
    cap: float = K.TARGET_CAP,
    share: float = 0.5,
    fit_fast: Fit | None = None,
    fit_slow: Fit | None = None,
) -> DataFrame:
    """Predictions of test rows by one model per segment: key, target, ``segment``, ``prediction``.

    The slow groups are found on the training half only and then looked up for
    both halves, so that no test value decides about its own segment.
    """
    needed = list(dict.fromkeys([key, target, *group_keys, *features]))
    train, test = hash_split(df.select(*needed), key, share)
    groups = cut_lineage(slow_groups(train, target, group_keys, above))
    train, test = (cap_below(flag_rows(part, groups, group_keys), target, cap) for part in (train, test))
    train = train.persist()
    try:
        # A segment without training rows is left to the model of the other one.
        trained = sorted(r[0] for r in train.select("is_slow").distinct().collect())
        plain = lambda rows, names: fit_linear(rows, names, target)
        chosen = {False: fit_fast or plain, True: fit_slow or plain}
        fitted = {slow: chosen[slow](train.filter(F.col("is_slow") == slow), features) for slow in trained}
    finally:
        train.unpersist()
    pieces = []
    for slow, rows in zip((False, True), split_by_flag(test, "is_slow")):
        model = fitted.get(slow) or fitted[trained[0]]
        pieces.append(model.predict(rows, keep=[key, target]).withColumn("segment", F.lit("slow" if slow else "fast")))
    return pieces[0].unionByName(pieces[1])


def segment_errors(scored: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Error per segment and pooled over both, in one pass."""
    return (
        scored.rollup("segment")
        .agg(F.count(error_of(target, "prediction")).alias("n"), rmse_of(target, "prediction").alias("rmse"))
        .select(F.coalesce("segment", F.lit("pooled")).alias("segment"), "n", "rmse")
    )


def rebalanced_forest(
    df: DataFrame,
    features: list[str],
    key: str = K.KEY,
    target: str = K.TARGET,
    width: float = K.BIN_WIDTH,
    per_bin: int = K.REBALANCE_TARGET,
    mode: str = "clean",
    share: float = 0.5,
    **forest,
) -> tuple[Model, DataFrame]:
    """Forest on the rebalanced training half, and its predictions of the other half."""
    needed = list(dict.fromkeys([key, target, *features]))
    train, test = hash_split(df.select(*needed), key, share)
    balanced = rebalance(train, target, key, width, per_bin, mode=mode)
    model = fit_forest(balanced, features, target, **forest)
    return model, model.predict(test, keep=[key, target])


@dataclass
class TrainReport:
    """What a training job measured on its validation (or training) rows.

    ``counts`` has, per file, the rows read, with a null-literal target (taken
    as 0), with a malformed one (no number), and left after the trim.
    """

    model: Model
    error: DataFrame
    histogram: DataFrame
    profile: DataFrame
    counts: DataFrame


def read_once(spark: SparkSession, path: str, profile: str, columns: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """Prepared columns of a log, stored, and its counts; the text is parsed once, and counted on the way."""
    raw = read_tsv(spark, path)
    text = F.col(K.TARGET)
    # Counted on the raw text, under the projection that types it.
    watch = Observation()
    watched = raw.observe(
        watch,
        F.count("*").alias("n_rows"),
        F.count_if(text == K.NULL_TEXT).alias("n_imputed"),
        F.count_if(as_double(K.TARGET).isNull()).alias("n_malformed"),
    )
    stored = scratch_path(spark, "prepared")
    prepared = prepare(watched, profile).select(*columns)
    prepared.write.parquet(stored)
    return spark.read.schema(prepared.schema).parquet(stored), dict(watch.get)


def train_job(
    spark: SparkSession,
    train_path: str,
    model_path: str,
    trim: float = K.TRIM_TRAIN,
    valid_path: str | None = None,
    valid_trim: float | None = K.TRIM_VALIDATION,
    profile: str = "production",
    features: list[str] | None = None,
    forest: dict | None = None,
    upper: float | None = None,
    width: float = K.BIN_WIDTH,
) -> TrainReport:
    """Read, prepare, trim, fit a forest, evaluate and save it.

    Every log is parsed once; trim, fit and scores use the stored columns. The
    scored rows are read once for all measures. The histogram reaches up to
    ``upper``, by default to the largest value.

    ``profile='spark'`` takes the 15 + 3 features and the deep forest of the
    single-file job, ``production`` the 18 features and the train/validation pair.
    """
    if features is None:
        features = K.FEATURES_SPARK if profile == "spark" else K.FEATURES_RF
    if forest is None:
        forest = K.FOREST_SPARK if profile == "spark" else K.FOREST_TRAIN

    def trimmed(path: str, percent: float) -> tuple[DataFrame, dict[str, int]]:
        rows, counts = read_once(spark, path, profile, [K.TARGET, *features])
        return keep_below(rows, K.TARGET, percentile_limit(rows, K.TARGET, percent)), counts

    train, counts = trimmed(train_path, trim)
    counted = [("train", counts, train)]
    model = fit_forest(train, features, **forest)
    model.save(model_path)
    check = train
    if valid_path:
        check, more = trimmed(valid_path, trim if valid_trim is None else valid_trim)
        counted.append(("validation", more, check))
    measures = measure(model.predict(check, keep=[K.TARGET]), K.TARGET, "prediction", width, upper)
    kept = [(name, c["n_rows"], c["n_imputed"], c["n_malformed"], rows.count()) for name, c, rows in counted]
    table = spark.createDataFrame(kept, "file string, n_rows bigint, n_imputed bigint, n_malformed bigint, n_kept bigint")
    return TrainReport(model, measures.error, measures.histogram, measures.profile, table)


@dataclass
class ScoreReport:
    """Scored rows, the histogram of their predictions, and how many rows were read and scored."""

    scored: DataFrame
    histogram: DataFrame
    counts: DataFrame


def score_job(
    spark: SparkSession,
    path: str,
    model_path: str,
    out_path: str | None = None,
    key: str = K.KEY,
    profile: str = "production",
    shift: float = 0.0,
    width: float = K.BIN_WIDTH,
    upper: float | None = None,
) -> ScoreReport:
    """Score a file with a saved model; every input row gets one prediction.

    The log is parsed and scored once, into a stored table that the written
    file, the histogram and the caller read.
    """
    model = Model.load(spark, model_path)
    watch = Observation()
    raw = read_tsv(spark, path).observe(watch, F.count("*").alias("n_rows"))
    scored = model.predict(prepare(raw, profile, scoring=True), keep=[key])
    if shift:
        scored = shifted(scored, "prediction", shift)
    place = scratch_path(spark, "scored")
    scored.write.parquet(place)
    scored = spark.read.schema(scored.schema).parquet(place)
    if out_path:
        write_predictions(scored, out_path, key)
    histogram = measure(scored, None, "prediction", width, upper).histogram
    counts = scored.agg(F.lit(watch.get["n_rows"]).cast("bigint").alias("n_rows"), F.count("prediction").alias("n_scored"))
    return ScoreReport(scored, histogram, counts)


def apply_job(
    spark: SparkSession,
    path: str,
    model_path: str,
    out_path: str | None = None,
    key: str = K.KEY,
    profile: str = "production",
    shift: float = 0.0,
) -> DataFrame:
    """The scored rows of ``score_job``."""
    return score_job(spark, path, model_path, out_path, key, profile, shift).scored
