"""One named query per operator or flow, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens import constants as K
from loadlens.functions import cleaning, files
from loadlens.functions.bins import nearest_edge
from loadlens.operators import descent, evaluate, groups, histogram, measures, products, profile, ranks, segments, split, trim
from loadlens.operators.profile import column_profile
from loadlens.operators.rebalance import rebalance
from loadlens.plans import flows, models, prepare
from loadlens.session import as_lookup, cut_lineage, scratch_path
from loadlens.sources import tsv
from loadlens.sources.impressions import impressions, table

Query = Callable[[SparkSession, str], DataFrame]

# Settings that suit the value range of the derived impression log.
WIDTH = 10.0
SLOW = 40.0
MIDDLE = 33.0
CAP = 187.0
PER_BIN = 500
AFTER, BEFORE = 1704100000, 1706500000

_SCREEN = ["TOPMOSTREACHABLEWINDOWWIDTH", "TOPMOSTREACHABLEWINDOWHEIGHT"]
_KEYS = ["COMBINEDID", "COMBINEDEXTERNALID", "PLATFORMCOMBINED", "UA_OSCOMB"]

_registry: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _typed(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    ads = impressions(spark, folder, list(columns) if columns else None)
    return ads.withColumns(prepare.numeric_columns(ads))


def _target(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return _typed(spark, folder, K.KEY, K.TARGET, *more)


def _prepared(spark: SparkSession, folder: str, columns: list[str], profile: str = "production", trim=K.NO_TRIM) -> DataFrame:
    """Key, target and the named raw or derived columns."""
    reads = prepare.inputs_of(profile, [K.KEY, K.TARGET, *columns])
    narrow = impressions(spark, folder, [K.TARGET])
    df = prepare.prepare(impressions(spark, folder, reads), profile, trim, narrow=narrow)
    return df.select(K.KEY, K.TARGET, *columns)


def _featured(spark: SparkSession, folder: str, profile: str, columns: list[str]) -> DataFrame:
    """Key and the named raw or derived text columns, without numbers."""
    ads = impressions(spark, folder, prepare.inputs_of(profile, [K.KEY, *columns]))
    return prepare.add_features(ads, profile).select(K.KEY, *columns)


def _r(c: Column | str, name: str, digits: int = 4) -> Column:
    return F.round(c, digits).alias(name)


def _with_group_mean(df: DataFrame, *keys: str, out: str = "prediction") -> DataFrame:
    means = df.groupBy(*keys).agg(F.avg(K.TARGET).alias(out))
    return df.join(as_lookup(means), list(keys))


# --- cleaning, casts, filters ------------------------------------------------


@_query
def null_literal_cast(spark, folder):
    return _typed(spark, folder, K.KEY, *K.DOUBLE_COLUMNS, *K.LONG_COLUMNS)


@_query
def null_text_replaced(spark, folder):
    ads = impressions(spark, folder, [K.KEY, "GEOIP_LAT", "PLATFORM"])
    return ads.select(
        K.KEY,
        cleaning.replace_null_text("GEOIP_LAT", "0").alias("lat_text"),
        cleaning.replace_null_text("PLATFORM", "").alias("platform_text"),
    )


@_query
def range_filters(spark, folder):
    df = _typed(spark, folder, K.KEY, "TIMESTAMP", *_SCREEN)
    df = df.withColumn("TOPMOSTREACHABLEWINDOWAREA", prepare.window_area())
    df = trim.keep_range(df, "TOPMOSTREACHABLEWINDOWAREA", at_least=K.AREA_MIN, below=K.AREA_BELOW)
    df = trim.keep_range(df, "TIMESTAMP", above=AFTER, below=BEFORE)
    return df.select(K.KEY, "TOPMOSTREACHABLEWINDOWAREA", "TIMESTAMP")


@_query
def audit_counts(spark, folder):
    df = _typed(spark, folder, "TIMESTAMP", *_SCREEN)
    area, time = prepare.window_area(), F.col("TIMESTAMP")
    return trim.audit(
        df,
        {
            "n_area_negative": area < K.AREA_MIN,
            "n_area_over": area > K.AREA_BELOW,
            "n_early": time <= AFTER,
            "n_late": time >= BEFORE,
        },
    )


@_query
def hard_cap(spark, folder):
    return trim.cap_below(_target(spark, folder), K.TARGET, CAP)


@_query
def null_key_filter(spark, folder):
    return trim.drop_key(_featured(spark, folder, "explore", ["PLATFORMCOMBINED"]), "PLATFORMCOMBINED", "null_null")


@_query
def trim_percentiles(spark, folder):
    df = _target(spark, folder)
    percents = [K.TRIM_EXPLORE, K.TRIM_TRAIN, K.TRIM_VALIDATION, K.TRIM_FILE_SIZE]
    limits = ranks.percentiles(df, K.TARGET, percents)
    kept = df.agg(*[F.count_if(F.col(K.TARGET) < t) for t in limits]).first()
    rows = spark.createDataFrame(list(zip(percents, limits, kept)), "percent double, threshold double, n_kept bigint")
    return rows.withColumn("threshold", F.round("threshold", 4))


@_query
def trim_line_items(spark, folder):
    items = table(spark, folder, "lineitem")
    return (
        trim.trim_above_percentile(items, "l_extendedprice", K.TRIM_TRAIN)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), _r(F.avg("l_extendedprice"), "mean_price"), F.max("l_extendedprice").alias("max_price"))
    )


# --- features ----------------------------------------------------------------


@_query
def combined_ids_explore(spark, folder):
    names = [
        "COMBINEDID",
        "COMBINEDIDWITHPLACEMENTID",
        "COMBINEDEXTERNALID",
        "PLATFORMCOMBINED",
        "UA_VENDORMODEL",
        "UA_OSCOMB",
        "UA_BROWSERCOMB",
    ]
    return _featured(spark, folder, "explore", names)


@_query
def combined_ids_production(spark, folder):
    return _featured(spark, folder, "production", _KEYS)


@_query
def combined_ids_spark(spark, folder):
    return _featured(spark, folder, "spark", _KEYS)


@_query
def geo_country_region(spark, folder):
    return _featured(spark, folder, "production", ["GEOIP_COUNTRY"])


@_query
def quote_strip(spark, folder):
    return _featured(spark, folder, "production", ["ERRORSJSON", "FILESJSON"])


@_query
def file_sizes_tokens(spark, folder):
    bare = cleaning.without_quotes("FILESJSON")
    return impressions(spark, folder, [K.KEY, "FILESJSON"]).select(
        K.KEY,
        files.image_size(bare).alias("image_size"),
        files.video_size(bare).alias("video_size"),
        files.image_size("FILESJSON", quoted=True).alias("image_size_quoted"),
    )


@_query
def file_sizes_total(spark, folder):
    ads = impressions(spark, folder, [K.KEY, "FILESJSON"])
    return ads.select(K.KEY, files.total_size("FILESJSON").alias("total_size"))


@_query
def file_sizes_json(spark, folder):
    return impressions(spark, folder, [K.KEY, "FILESJSON"]).select(
        K.KEY,
        files.json_size("FILESJSON", "image").alias("image_size"),
        files.json_size("FILESJSON", "video").alias("video_size"),
        files.json_size("FILESJSON").alias("total_size"),
    )


@_query
def equality_flags(spark, folder):
    df = _featured(spark, folder, "production", ["INTENDENTISACTUALDEVICETYPE", "PLATFORMCOMBINEDISOSCAOMB"])
    flag = F.col("INTENDENTISACTUALDEVICETYPE")
    return df.select(K.KEY, flag, flag.cast("int").alias("same_device_int"), "PLATFORMCOMBINEDISOSCAOMB")


@_query
def prepare_production(spark, folder):
    return prepare.prepare(impressions(spark, folder), "production")


@_query
def prepare_spark(spark, folder):
    return _prepared(spark, folder, K.FEATURES_SPARK, "spark", K.TRIM_TRAIN)


@_query
def prepare_explore(spark, folder):
    narrow = impressions(spark, folder, prepare.EXPLORE_TRIMS)
    return prepare.explore(impressions(spark, folder), time_after=AFTER, time_before=BEFORE, narrow=narrow)


@_query
def drop_columns(spark, folder):
    return impressions(spark, folder).drop(*K.EXPLORE_DROPPED, "ERRORSJSON", "FILESJSON")


@_query
def select_features(spark, folder):
    return _featured(spark, folder, "explore", K.FEATURES_LR)


@_query
def constant_and_shift(spark, folder):
    df = _target(spark, folder).withColumn("constant", cleaning.constant(K.BASELINE_CONSTANT))
    df = evaluate.shifted(df.withColumn("shifted", F.col(K.TARGET)), "shifted", K.SCORE_SHIFT)
    return df.select(K.KEY, "constant", _r("shifted", "shifted"))


# --- group statistics --------------------------------------------------------


@_query
def placement_stats(spark, folder):
    df = trim.trim_above_percentile(_target(spark, folder, "PLACEMENTID"), K.TARGET, K.TRIM_EXPLORE)
    spread = groups.group_spread(df, ["PLACEMENTID"], K.TARGET)
    return spread.select("PLACEMENTID", "n", _r("mean", "mean", 8), _r("median", "median"), _r("std", "std"))


@_query
def group_divider_stats(spark, folder):
    df = _prepared(spark, folder, K.SEGMENT_KEYS_WIDE)
    spread = groups.group_spread(df, K.SEGMENT_KEYS_WIDE, K.TARGET, many=True)
    return spread.select(*K.SEGMENT_KEYS_WIDE, "n", _r("median", "median"), _r("std", "std"))


@_query
def line_item_spread(spark, folder):
    items = table(spark, folder, "lineitem")
    spread = groups.group_spread(items, ["l_returnflag"], "l_extendedprice")
    return spread.select("l_returnflag", "n", _r("mean", "mean"), _r("median", "median"), _r("std", "std"))


@_query
def feature_group_means(spark, folder):
    features = ["COMBINEDID", "PLACEMENTID", "FILESJSON", "PLATFORMCOMBINED", "UA_BROWSER"]
    df = _prepared(spark, folder, features)
    means = groups.group_means(df, features, K.TARGET)
    # Means of a few two-digit values often end in a five: compare them unrounded as far as it goes.
    return means.select("feature", "level", "n", _r("mean", "mean", 6))


@_query
def global_stats(spark, folder):
    df = _target(spark, folder)
    (middle,) = ranks.percentiles(df, K.TARGET, [50.0])
    return df.agg(
        F.count("*").alias("n_rows"), _r(F.avg(K.TARGET), "mean"), F.max(K.TARGET).alias("max"), _r(F.lit(middle), "median")
    )


@_query
def label_index(spark, folder):
    df = _featured(spark, folder, "spark", K.FEATURES_SPARK_CATEGORICAL)
    return groups.label_index(df, K.FEATURES_SPARK_CATEGORICAL)


@_query
def encode_rows(spark, folder):
    ads = impressions(spark, folder, [K.KEY, "UA_MODEL", "UA_VENDOR"])
    index = cut_lineage(groups.label_index(ads, ["UA_MODEL", "UA_VENDOR"]))
    for c in ("UA_MODEL", "UA_VENDOR"):
        ads = groups.encode_labels(ads, c, index, f"_{c}")
    return ads.select(K.KEY, "_UA_MODEL", "_UA_VENDOR")


@_query
def profile_columns(spark, folder):
    p = column_profile(impressions(spark, folder))
    return p.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@_query
def profile_sketched(spark, folder):
    """The one-pass profile, each sketch held against the exact profile and its stated bound."""
    ads = impressions(spark, folder)
    rough, exact = profile.sketch_profile(ads), column_profile(ads).select("column", F.col("n_distinct").alias("_distinct"), F.col("top_count").alias("_top"))
    both = rough.join(exact, "column")
    return both.select(
        "column",
        "n_rows",
        "n_null_text",
        "min_value",
        "max_value",
        _r("mean", "mean"),
        _r("std", "std"),
        (F.abs(F.col("n_distinct") - F.col("_distinct")) <= profile.DISTINCT_BOUND * F.col("_distinct") + 0.5).alias("distinct_close"),
        (F.abs(F.col("top_count") - F.col("_top")) <= profile.TOP_BOUND * F.col("n_rows")).alias("top_close"),
    )


# --- errors and histograms ---------------------------------------------------


@_query
def baseline_rmse(spark, folder):
    df = _target(spark, folder)
    mean = evaluate.baseline_rmse(df, K.TARGET).withColumn("baseline", F.lit("mean"))
    fixed = evaluate.baseline_rmse(df, K.TARGET, K.BASELINE_CONSTANT).withColumn("baseline", F.lit("constant"))
    return mean.unionByName(fixed).select("baseline", "n", _r("mean", "mean"), _r("rmse", "rmse"))


@_query
def rmse_shifted(spark, folder):
    df = _with_group_mean(_target(spark, folder, "PLACEMENTID"), "PLACEMENTID")
    df = histogram.absolute_error(df, K.TARGET, "prediction")
    moved = F.col("prediction") + K.SCORE_SHIFT
    return df.agg(
        F.count("*").alias("n"),
        _r(evaluate.rmse_of(K.TARGET, "prediction"), "rmse"),
        _r(evaluate.rmse_of(F.col(K.TARGET), moved), "rmse_shifted"),
        _r(F.avg("abs_error"), "mean_abs_error"),
    )


@_query
def hist_fixed(spark, folder):
    df = _target(spark, folder)
    edges = histogram.edges_for(df, K.TARGET, WIDTH)
    return histogram.histogram(df, K.TARGET, WIDTH, edges=edges)


@_query
def hist_overlay(spark, folder):
    df = _with_group_mean(_target(spark, folder, "CREATIVEID"), "CREATIVEID")
    edges = histogram.edges_for(df, K.TARGET, WIDTH, whole="int")
    return histogram.histogram(df, [K.TARGET, "prediction"], WIDTH, edges=edges)


@_query
def hist_group_medians(spark, folder):
    df = _prepared(spark, folder, K.SEGMENT_KEYS)
    medians = groups.group_spread(df, K.SEGMENT_KEYS, K.TARGET).select("median")
    edges = histogram.edges_for(medians, "median", WIDTH)
    return histogram.histogram(medians, "median", WIDTH, edges=edges)


@_query
def hist_group_means(spark, folder):
    """Of every feature, how its levels' means are spread."""
    features = ["COMBINEDID", "PLACEMENTID", "FILESJSON", "PLATFORMCOMBINED", "UA_BROWSER"]
    means = cut_lineage(groups.group_means(_prepared(spark, folder, features), features, K.TARGET))
    return histogram.histograms_by(means, "feature", "mean", WIDTH, edges=histogram.edges_for(means, "mean", WIDTH))


@_query
def nearest_edges(spark, folder):
    df = _target(spark, folder)
    edges = histogram.edges_for(df, K.TARGET, WIDTH)
    return df.select(K.KEY, nearest_edge(F.col(K.TARGET), WIDTH, edges).alias("bin"))


@_query
def error_profile(spark, folder):
    df = _with_group_mean(_target(spark, folder, "PLACEMENTID"), "PLACEMENTID")
    found = histogram.error_profile(df, K.TARGET, "prediction", WIDTH)
    return found.withColumn("mean_abs_error", F.round("mean_abs_error", 4))


@_query
def error_profile_pooled(spark, folder):
    df = _target(spark, folder, "SDK", "PLACEMENTID")
    parts = segments.split_by_flag(df.withColumn("mraid", F.col("SDK") == "MRAID"), "mraid")
    scored = [_with_group_mean(part, "PLACEMENTID") for part in parts]
    found = histogram.pooled_error_profile(scored, K.TARGET, "prediction", WIDTH)
    return found.withColumn("mean_abs_error", F.round("mean_abs_error", 4))


# --- splits, segments, rebalancing -------------------------------------------


@_query
def hash_split(spark, folder):
    first, second = split.hash_split(impressions(spark, folder, [K.KEY]), K.KEY, 0.5)
    return first.select(K.KEY, F.lit("train").alias("part")).unionByName(
        second.select(K.KEY, F.lit("test").alias("part"))
    )


@_query
def random_sample(spark, folder):
    return split.random_sample(impressions(spark, folder), 0.1, seed=1)


@_query
def random_halves(spark, folder):
    first, second = split.random_halves(impressions(spark, folder, [K.KEY, K.TARGET]))
    return first.withColumn("part", F.lit("train")).unionByName(second.withColumn("part", F.lit("test")))


def _near(n: Column, all_rows: Column, share: float) -> Column:
    """Whether a random part has its share of the rows, within five deviations."""
    return F.abs(n - all_rows * share) <= 5 * F.sqrt(all_rows * share * (1 - share))


@_query
def random_sample_check(spark, folder):
    """The sample has its share of the rows, each once, and none from elsewhere."""
    ads = impressions(spark, folder, [K.KEY])
    drawn = split.random_sample(ads, 0.1, seed=1).withColumn("drawn", F.lit(1))
    both = ads.withColumn("drawn", F.lit(0)).unionByName(drawn).groupBy(K.KEY).agg(F.count("*").alias("n"), F.sum("drawn").alias("drawn"))
    rows = F.sum(F.col("n") - F.col("drawn"))
    return both.agg(
        rows.alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if((F.col("drawn") > 1) | (F.col("drawn") == F.col("n"))).alias("n_wrong"),
        _near(F.sum("drawn"), rows, 0.1).alias("share_held"),
    )


@_query
def random_halves_check(spark, folder):
    """The halves hold every row once, each half its share."""
    first, second = split.random_halves(impressions(spark, folder, [K.KEY]))
    parts = first.withColumn("in_train", F.lit(1)).unionByName(second.withColumn("in_train", F.lit(0)))
    keys = parts.groupBy(K.KEY).agg(F.count("*").alias("n"), F.sum("in_train").alias("train"))
    return keys.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), _near(F.sum("train"), F.sum("n"), 0.5).alias("share_held")
    )


@_query
def exact_sample(spark, folder):
    """1,000 rows (all, if there are fewer) by the order of their digests."""
    return split.exact_sample(_target(spark, folder), K.KEY, 1_000)


@_query
def exact_halves(spark, folder):
    first, second = split.exact_halves(impressions(spark, folder, [K.KEY, K.TARGET]), K.KEY)
    return first.withColumn("part", F.lit("train")).unionByName(second.withColumn("part", F.lit("test")))


def _gappy(spark: SparkSession, folder: str) -> DataFrame:
    """Impressions with NULL keys, NULL flags and NaN or NULL numbers here and there."""
    i = F.col(K.KEY)
    nan = F.lit(float("nan"))
    return _target(spark, folder, "PLACEMENTID").select(
        F.when(i % 31 != 0, i).alias("id"),
        F.when(i % 5 != 0, F.col("PLACEMENTID")).alias("place"),
        F.when(i % 7 != 0, i % 2 == 0).alias("flag"),
        F.when(i % 11 == 0, nan).when(i % 13 != 0, F.col(K.TARGET)).alias("y"),
        F.when(i % 17 == 0, nan).when(i % 19 != 0, F.sqrt(F.abs(F.col(K.TARGET))) + 1).alias("p"),
    )


@_query
def missing_in_measures(spark, folder):
    """Rows that enter and the measures, where keys, targets and predictions are missing."""
    df = _gappy(spark, folder)
    error = evaluate.rmse(df, "y", "p").select(F.lit("rmse").alias("measure"), F.lit(None).cast("string").alias("level"), "n", F.col("rmse").alias("value"))
    base = evaluate.baseline_rmse(df, "y").select(F.lit("baseline").alias("measure"), F.lit(None).cast("string").alias("level"), "n", F.col("rmse").alias("value"))
    means = groups.group_means(df, ["place"], "y").select(F.lit("mean").alias("measure"), "level", "n", F.col("mean").alias("value"))
    near = histogram.error_profile(df, "y", "p", WIDTH).select(F.lit("profile").alias("measure"), F.col("bin").cast("string").alias("level"), "n", F.col("mean_abs_error").alias("value"))
    return error.unionByName(base).unionByName(means).unionByName(near).withColumn("value", F.round("value", 4))


@_query
def missing_in_splits(spark, folder):
    """Rows per part of every split, where keys and flags are missing: each row is in one part."""
    df = _gappy(spark, folder)
    slow = segments.slow_groups(df, "y", ["place"], MIDDLE)
    parts = {
        "hash": split.hash_split(df, "id"),
        "flag": segments.split_by_flag(df, "flag"),
        "slow": (segments.rows_not_in(df, slow, ["place"]), segments.rows_in(df, slow, ["place"])),
        "marked": segments.split_by_flag(segments.flag_rows(df, slow, ["place"]), "is_slow"),
    }
    counted = [
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("split"), F.lit(i).cast("bigint").alias("part"), "n")
        for name, halves in parts.items()
        for i, rows in enumerate(halves)
    ]
    return reduce(DataFrame.unionByName, counted)


def _slow(df: DataFrame) -> DataFrame:
    return segments.slow_groups(df, K.TARGET, K.SEGMENT_KEYS, SLOW)


@_query
def slow_group_keys(spark, folder):
    return _slow(_prepared(spark, folder, K.SEGMENT_KEYS))


@_query
def slow_group_semi(spark, folder):
    df = _prepared(spark, folder, K.SEGMENT_KEYS)
    return segments.rows_in(df, _slow(df), K.SEGMENT_KEYS)


@_query
def slow_group_anti(spark, folder):
    df = _prepared(spark, folder, K.SEGMENT_KEYS)
    return segments.rows_not_in(df, _slow(df), K.SEGMENT_KEYS)


@_query
def slow_flag(spark, folder):
    df = _prepared(spark, folder, K.SEGMENT_KEYS)
    return segments.flag_rows(df, _slow(df), K.SEGMENT_KEYS).select(K.KEY, "is_slow")


@_query
def segment_rmse_pooled(spark, folder):
    df = _prepared(spark, folder, K.SEGMENT_KEYS)
    flagged = segments.flag_rows(df, _slow(df), K.SEGMENT_KEYS)
    flagged = flagged.withColumn("segment", F.when(F.col("is_slow"), "slow").otherwise("fast"))
    scored = _with_group_mean(flagged, "segment", "PLACEMENTID")
    return flows.segment_errors(scored).withColumn("rmse", F.round("rmse", 4))


def _copies(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    df = _target(spark, folder)
    return (
        rebalance(df, K.TARGET, K.KEY, WIDTH, PER_BIN, mode=mode).groupBy(K.KEY, "bin").agg(F.count("*").alias("copies"))
    )


@_query
def rebalance_compat(spark, folder):
    return _copies(spark, folder, "compat")


@_query
def rebalance_clean(spark, folder):
    return _copies(spark, folder, "clean")


@_query
def first_k_per_bin(spark, folder):
    df = _target(spark, folder)
    edges = histogram.edges_for(df, K.TARGET, WIDTH)
    df = df.select("*", nearest_edge(F.col(K.TARGET), WIDTH, edges).alias("bin"))
    return ranks.first_rows(df, ["bin"], K.KEY, 5)


@_query
def first_row(spark, folder):
    return impressions(spark, folder).orderBy(K.KEY).limit(1)


@_query
def union_append(spark, folder):
    df = _target(spark, folder)
    return df.unionByName(df.filter(F.col(K.TARGET) >= CAP))


# --- files -------------------------------------------------------------------


@_query
def tsv_roundtrip(spark, folder):
    path = scratch_path(spark, "impressions")
    tsv.write_tsv(impressions(spark, folder), path)
    return tsv.read_tsv(spark, path)


@_query
def tsv_odd_texts(spark, folder):
    """Outer blanks, quotes, backslashes and empty texts survive; repeated headers inside the files go."""
    path = scratch_path(spark, "odd")
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("PARTKEY"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("BLANKS"),
        F.concat(F.lit('"'), "p_brand", F.lit("\\n, '\\")).alias("MARKS"),
        F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type")).alias("GAPS"),
    )
    headers = table(spark, folder, "region").select(*[F.lit(c).alias(c) for c in rows.columns])
    tsv.write_tsv(rows.unionByName(headers), path)
    return tsv.read_tsv(spark, path)


@_query
def tsv_mixed_headers(spark, folder):
    """Two files with the same columns in another order, one with a column more, read as one table."""
    path = scratch_path(spark, "mixed")
    ads = impressions(spark, folder, [K.KEY, K.TARGET, "SDK", "PLACEMENTID", "CREATIVETYPE"])
    even = ads.where(F.col(K.KEY) % 2 == 0).select(K.KEY, "PLACEMENTID", K.TARGET, "SDK")
    odd = ads.where(F.col(K.KEY) % 2 == 1).select("SDK", K.TARGET, "CREATIVETYPE", K.KEY, "PLACEMENTID")
    tsv.write_tsv(even.coalesce(1), path)
    tsv.write_tsv(odd.coalesce(1), path, mode="append")
    return tsv.read_aligned(spark, path)


@_query
def predictions_roundtrip(spark, folder):
    path = scratch_path(spark, "predictions")
    scored = _target(spark, folder).select(K.KEY, F.round(F.col(K.TARGET) + K.SCORE_SHIFT, 4).alias("prediction"))
    tsv.write_predictions(scored, path, K.KEY)
    back = tsv.read_tsv(spark, path)
    return back.select(F.col(K.KEY).try_cast("bigint").alias(K.KEY), F.col("prediction").try_cast("double").alias("prediction"))


# --- models ------------------------------------------------------------------


@_query
def lr_single_numeric(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    train, test = split.hash_split(items, "l_orderkey", 0.5)
    model = models.fit_linear(train, ["l_quantity"], "l_extendedprice")
    scored = model.predict(test, keep=["l_extendedprice"])
    return evaluate.rmse(scored, "l_extendedprice", "prediction").select("n", _r("rmse", "rmse"))


@_query
def lr_single_categorical(spark, folder):
    df = _target(spark, folder, "PLACEMENTID")
    train, test = split.hash_split(df, K.KEY, 0.5)
    scored = models.fit_linear(train, ["PLACEMENTID"]).predict(test, keep=[K.KEY])
    return scored.select(K.KEY, _r("prediction", "prediction"))


def _in_train() -> Column:
    return split.hash_bucket(K.KEY) < 500


def _compared(df: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    return flows.compare_lists(df, _in_train(), sets).withColumn("rmse", F.round("rmse", 4))


@_query
def feature_comparison(spark, folder):
    names = ["COMBINEDID", "PLACEMENTID", "UA_VENDOR", "UA_MODEL", "UA_OS", "PLATFORMCOMBINED", "COMBINEDEXTERNALID"]
    return _compared(_prepared(spark, folder, names), {n: [n] for n in names})


@_query
def device_feature_sets(spark, folder):
    """The joint id alone and with vendor, model, system and browser columns, one by one, together and joined."""
    found = [["UA_VENDOR", "UA_MODEL"], ["UA_OS", "UA_OSVERSION"], ["UA_BROWSERVERSION", "UA_BROWSER"]]
    lists = [[], *[[c] for pair in found for c in pair], *found, ["UA_VENDORMODEL"], ["UA_OSCOMB"], ["UA_BROWSERCOMB"]]
    sets = {" and ".join(["COMBINEDID", *more]): ["COMBINEDID", *more] for more in lists}
    return _compared(_prepared(spark, folder, list(dict.fromkeys(c for x in sets.values() for c in x)), "explore"), sets)


@_query
def ablation_scan(spark, folder):
    numbers = ["TIMESTAMP", "TOPMOSTREACHABLEWINDOWAREA", "FILESJSON_IMGSIZE", "FILESJSON_VIDSIZE", "GEOIP_LNG"]
    df = _prepared(spark, folder, ["PLACEMENTID", *numbers])
    return _compared(df, flows.add_one_sets(numbers, ["PLACEMENTID"]))


@_query
def ablation_scan_text(spark, folder):
    added = ["UA_BROWSERVERSION", "UA_VENDOR", "CREATIVETYPE"]
    return _compared(_prepared(spark, folder, ["COMBINEDID", *added]), flows.add_one_sets(added, ["COMBINEDID"]))


#: What the exploration still has when it adds one column after the other.
REMAINING = [
    c
    for c in dict.fromkeys([*K.RAW_COLUMNS, "COMBINEDID", "COMBINEDIDWITHPLACEMENTID", "COMBINEDEXTERNALID", "PLATFORMCOMBINED", "UA_VENDORMODEL", "UA_OSCOMB", "UA_BROWSERCOMB", "INTENDENTISACTUALDEVICETYPE"])
    if c not in (K.TARGET, *K.EXPLORE_DROPPED)
]


@_query
def ablation_every_column(spark, folder):
    """The joint id alone and with every remaining column added, but for the list of files."""
    columns = [c for c in REMAINING if c != "FILESJSON"]
    return _compared(_prepared(spark, folder, columns, "explore"), flows.add_one_sets(columns, ["COMBINEDID"]))


@_query
def ablation_file_list(spark, folder):
    """The joint id with the list of files, a label for nearly every row; SQL's group means take too many rounds on it."""
    columns = ["COMBINEDID", "FILESJSON"]
    return _compared(_prepared(spark, folder, columns, "explore"), {"FILESJSON": columns})


def _list_sets() -> dict[str, list[str]]:
    first = flows.add_one_sets(REMAINING, K.FEATURES_LR)
    second = flows.add_one_sets(REMAINING, K.FEATURES_LR_SECOND_BASE)
    return {f"first {n}": x for n, x in first.items()} | {f"second {n}": x for n, x in second.items()}


@_query
def ablation_lists(spark, folder):
    """Both long base lists, alone and with every remaining column added."""
    return _compared(_prepared(spark, folder, REMAINING, "explore"), _list_sets())


@_query
def ablation_lists_check(spark, folder):
    """The same lists: judged rows, and whether every label's training residuals add up to zero."""
    found = products.fits(_prepared(spark, folder, REMAINING, "explore"), _in_train(), K.TARGET, _list_sets(), beyond=descent.block_fits)
    return found.select("name", "n", F.round("residual", 4).alias("residual"))


@_query
def null_key_exclusion(spark, folder):
    df = _target(spark, folder, *prepare.inputs_of("explore", ["COMBINEDID", "PLATFORMCOMBINED"]))
    df = prepare.add_features(df, "explore")
    sets = {"COMBINEDID": ["COMBINEDID"], "PLATFORMCOMBINED": ["PLATFORMCOMBINED"]}
    result = flows.without_key(df, _in_train(), "PLATFORMCOMBINED", "null_null", sets)
    return result.withColumn("rmse", F.round("rmse", 4))


@_query
def segmented_models(spark, folder):
    df = _prepared(spark, folder, ["PLACEMENTID", "CREATIVETYPE"])
    scored = flows.segmented_models(
        df, ["PLACEMENTID"], group_keys=["PLACEMENTID", "CREATIVETYPE"], above=SLOW, cap=CAP
    )
    return flows.segment_errors(scored).withColumn("rmse", F.round("rmse", 4))


@_query
def segmented_forests(spark, folder):
    df = _prepared(spark, folder, K.FEATURES_RF)

    def forest(depth):
        return lambda rows, names: models.fit_forest(rows, names, trees=10, depth=depth, rows=0.5)

    return flows.segmented_models(
        df,
        K.FEATURES_RF,
        group_keys=["PLACEMENTID", "CREATIVETYPE"],
        above=SLOW,
        cap=CAP,
        fit_fast=forest(6),
        fit_slow=forest(8),
    )


def _forest_facts(model: models.Model, train: DataFrame, test: DataFrame) -> DataFrame:
    """Trees, rows, error of the mean, and whether each test row got a mean of training targets."""
    low, high = train.agg(F.min(K.TARGET), F.max(K.TARGET)).first()
    scored = model.predict(test, keep=[K.TARGET])
    return scored.agg(
        F.lit(model.about["trees"]).alias("trees"),
        F.lit(model.about["wanted_depth"]).alias("wanted_depth"),
        F.lit(model.about["depth"]).alias("depth"),
        F.count("prediction").alias("n"),
        _r(F.stddev_pop(K.TARGET), "baseline"),
        (F.count_if(F.col("prediction").between(low - 1e-9, high + 1e-9)) == F.count("*")).alias("all_in_range"),
    )


def _full_forest(spark: SparkSession, folder: str, features: list[str], profile: str, settings: dict) -> DataFrame:
    train, test = split.hash_split(_prepared(spark, folder, features, profile, K.TRIM_TRAIN), K.KEY, 0.5)
    return _forest_facts(models.fit_forest(train, features, **settings), train, test)


@_query
def forest_spark_full(spark, folder):
    """The single-file job's forest at its own size."""
    return _full_forest(spark, folder, K.FEATURES_SPARK, "spark", K.FOREST_SPARK)


@_query
def forest_train_full(spark, folder):
    """The train/validation job's forest at its own size."""
    return _full_forest(spark, folder, K.FEATURES_RF, "production", K.FOREST_TRAIN)


@_query
def segmented_forests_full(spark, folder):
    """One forest per segment at the exploration's sizes: rows per segment, and whether each has a prediction."""
    df = _prepared(spark, folder, K.FEATURES_RF)

    def forest(settings):
        return lambda rows, names: models.fit_forest(rows, names, **settings)

    scored = flows.segmented_models(
        df, K.FEATURES_RF, group_keys=["PLACEMENTID", "CREATIVETYPE"], above=SLOW, cap=CAP, fit_fast=forest(K.FOREST_EXPLORE), fit_slow=forest(K.FOREST_SLOW)
    )
    return scored.groupBy("segment").agg(F.count("*").alias("n"), F.count("prediction").alias("n_scored"), _r(F.stddev_pop(K.TARGET), "baseline"))


@_query
def rebalanced_forest_full(spark, folder):
    """The rebalanced training at the exploration's size: test rows and their predictions."""
    df = _prepared(spark, folder, K.FEATURES_RF)
    _, scored = flows.rebalanced_forest(df, K.FEATURES_RF, width=WIDTH, per_bin=PER_BIN, **K.FOREST_EXPLORE)
    return scored.agg(F.count("*").alias("n"), F.count("prediction").alias("n_scored"), _r(F.stddev_pop(K.TARGET), "baseline"))


@_query
def rf_predict(spark, folder):
    df = _prepared(spark, folder, K.FEATURES_SPARK, "spark", K.TRIM_TRAIN)
    train, test = split.hash_split(df, K.KEY, 0.5)
    model = models.fit_forest(train, K.FEATURES_SPARK, trees=10, depth=8)
    return model.predict(test, keep=[K.KEY, K.TARGET])


@_query
def rebalanced_rf(spark, folder):
    df = _prepared(spark, folder, K.FEATURES_RF)
    _, scored = flows.rebalanced_forest(
        df, K.FEATURES_RF, width=WIDTH, per_bin=PER_BIN, trees=10, depth=8, rows=0.5
    )
    return scored


def _two_logs(spark: SparkSession, folder: str) -> tuple[str, str]:
    ads = impressions(spark, folder)
    paths = scratch_path(spark, "train"), scratch_path(spark, "valid")
    for part, path in zip(split.hash_split(ads, K.KEY), paths):
        tsv.write_tsv(part, path)
    return paths


@_query
def train_validate_job(spark, folder):
    """Train on one file, judge on another, each with its own trim: row counts, and the actual values per bin and edge."""
    train, valid = _two_logs(spark, folder)
    report = flows.train_job(
        spark, train, scratch_path(spark, "model"), valid_path=valid, forest={"trees": 5, "depth": 8, "rows": 0.9, "columns": "0.6"}, upper=200.0, width=WIDTH
    )
    counts = report.counts.unpivot(["file"], ["n_rows", "n_imputed", "n_malformed", "n_kept"], "measure", "n")
    parts = [
        counts.select(F.concat_ws(" ", "file", "measure").alias("measure"), F.lit(None).cast("bigint").alias("bin"), "n"),
        report.error.select(F.lit("judged").alias("measure"), F.lit(None).cast("bigint").alias("bin"), "n"),
        report.histogram.select(F.lit("histogram").alias("measure"), "bin", F.col(f"n_{K.TARGET.lower()}").alias("n")),
        report.profile.select(F.lit("profile").alias("measure"), "bin", "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def score_histogram(spark, folder):
    """Score a file: its rows, its predictions, and the predictions counted in the histogram."""
    logs, saved = scratch_path(spark, "log"), scratch_path(spark, "model")
    tsv.write_tsv(impressions(spark, folder), logs)
    flows.train_job(spark, logs, saved, features=K.FEATURES_RF_LITE, forest={"trees": 5, "depth": 6})
    report = flows.score_job(spark, logs, saved, width=WIDTH)
    return report.counts.crossJoin(report.histogram.agg(F.sum("n_prediction").alias("n_in_histogram")))


@_query
def measures_at_once(spark, folder):
    """Error, both histograms and the profile of the group mean from one pass."""
    df = _with_group_mean(_target(spark, folder, "PLACEMENTID"), "PLACEMENTID")
    found = measures.measure(df, K.TARGET, "prediction", WIDTH)
    none = F.lit(None).cast("bigint")
    parts = [
        found.error.select(F.lit("error").alias("measure"), none.alias("bin"), "n", none.alias("n_prediction"), _r("rmse", "value")),
        found.histogram.select(F.lit("histogram").alias("measure"), "bin", F.col("n_adloadingtime").alias("n"), "n_prediction", F.col("lower").alias("value")),
        found.profile.select(F.lit("profile").alias("measure"), "bin", "n", none.alias("n_prediction"), _r("mean_abs_error", "value")),
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def train_apply_roundtrip(spark, folder):
    """Train from a file, score a file with the saved model, compare with the model in memory."""
    logs, saved = scratch_path(spark, "log"), scratch_path(spark, "model")
    tsv.write_tsv(impressions(spark, folder), logs)
    report = flows.train_job(
        spark, logs, saved, features=K.FEATURES_RF_LITE, forest={"trees": 10, "depth": 8, "rows": 0.9, "columns": "0.6"}
    )
    again = flows.apply_job(spark, logs, saved).withColumnRenamed("prediction", "_again")
    direct = report.model.predict(prepare.prepare(tsv.read_tsv(spark, logs), scoring=True), keep=[K.KEY])
    return direct.join(again, K.KEY).select(
        F.col(K.KEY).try_cast("bigint").alias(K.KEY), (F.col("prediction") == F.col("_again")).alias("same")
    )
