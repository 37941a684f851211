"""The three named feature sets.

Each is one projection over the raw text columns, plus the row filters that
belong to it. Columns that an input lacks are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens import constants as K
from loadlens.functions import cleaning, files, keys
from loadlens.operators.trim import keep_below, keep_range, percentile_limit, trim_above_percentile


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> dict[str, Column]:
    """Typed versions of the numeric text columns that ``df`` has."""
    has = set(df.columns) - set(skip)
    typed = {c: cleaning.as_double(c) for c in K.DOUBLE_COLUMNS if c in has}
    typed.update({c: cleaning.as_long(c) for c in K.LONG_COLUMNS if c in has})
    return typed


def _numbered(df: DataFrame, scoring: bool) -> DataFrame:
    skip = (K.TARGET,) if scoring else ()
    return df.withColumns(numeric_columns(df, skip))


def window_area() -> Column:
    return F.col("TOPMOSTREACHABLEWINDOWWIDTH") * F.col("TOPMOSTREACHABLEWINDOWHEIGHT")


_SCREEN = ["TOPMOSTREACHABLEWINDOWWIDTH", "TOPMOSTREACHABLEWINDOWHEIGHT"]
_PLACE = ["GEOIP_COUNTRY", "GEOIP_REGION"]
_PLATFORM = ["PLATFORM", "PLATFORMVERSION"]
_SYSTEM = ["UA_OS", "UA_OSVERSION"]
_DEVICE = ["INTENDEDDEVICETYPE", "ACTUALDEVICETYPE"]
_AD = ["ACCOUNTID", "CAMPAIGNID", "CREATIVEID"]
_EXTERNAL = ["EXTERNALPLACEMENTID", "EXTERNALSITEID", "EXTERNALSUPPLIERID"]

# Raw columns behind the row filters of the exploration set.
EXPLORE_TRIMS = [K.TARGET, "TIMESTAMP", *_SCREEN, "FILESJSON"]

# Feature name -> the columns it reads, and its expression.
Features = dict[str, tuple[list[str], Column]]


def _production_features() -> Features:
    platform = cleaning.blank_to(cleaning.replace_null_text(keys.joined(*_PLATFORM), ""))
    system = keys.joined(*_SYSTEM)
    listed = cleaning.without_quotes("FILESJSON")
    return {
        "TOPMOSTREACHABLEWINDOWAREA": (_SCREEN, window_area()),
        "GEOIP_COUNTRY": (_PLACE, keys.country_region(*_PLACE)),
        "ERRORSJSON": (["ERRORSJSON"], cleaning.without_quotes("ERRORSJSON")),
        "FILESJSON": (["FILESJSON"], listed),
        "FILESJSON_IMGSIZE": (["FILESJSON"], files.image_size(listed)),
        "FILESJSON_VIDSIZE": (["FILESJSON"], files.video_size(listed)),
        "COMBINEDID": (_AD, keys.joined(*_AD)),
        "COMBINEDEXTERNALID": (_EXTERNAL, keys.joined(*_EXTERNAL)),
        "PLATFORMCOMBINED": (_PLATFORM, platform),
        "UA_OSCOMB": (_SYSTEM, system),
        "INTENDENTISACTUALDEVICETYPE": (_DEVICE, keys.same(*_DEVICE)),
        "PLATFORMCOMBINEDISOSCAOMB": (_PLATFORM + _SYSTEM, platform == system),
    }


def _spark_features() -> Features:
    def bare(names: list[str]) -> tuple[list[str], Column]:
        return names, keys.joined(*[cleaning.replace_null_text(n, "") for n in names])

    return {
        "TOPMOSTREACHABLEWINDOWAREA": (_SCREEN, window_area()),
        "INTENDENTISACTUALDEVICETYPE": (_DEVICE, keys.same(*_DEVICE).cast("int")),
        "COMBINEDID": (_AD + ["SDK"], keys.joined(*_AD, "SDK")),
        "COMBINEDEXTERNALID": bare(["EXTERNALADSERVER", *_EXTERNAL]),
        "PLATFORMCOMBINED": bare(_PLATFORM),
        "UA_OSCOMB": bare(_SYSTEM),
        "FILESJSON_SIZE": (["FILESJSON"], files.total_size("FILESJSON")),
    }


def _explore_features() -> Features:
    def key(names: list[str]) -> tuple[list[str], Column]:
        return names, keys.joined(*names, sep="_")

    ids = ["SDK", *_AD, "EXTERNALADSERVER"]
    return {
        "GEOIP_COUNTRY": (_PLACE, keys.country_region(*_PLACE)),
        "ERRORSJSON": (["ERRORSJSON"], cleaning.without_quotes("ERRORSJSON")),
        "COMBINEDID": key(ids),
        "COMBINEDIDWITHPLACEMENTID": key([*ids, "PLACEMENTID"]),
        "COMBINEDEXTERNALID": (_EXTERNAL, keys.collapse_null_key(key(_EXTERNAL)[1])),
        "PLATFORMCOMBINED": key(_PLATFORM),
        "UA_VENDORMODEL": key(["UA_VENDOR", "UA_MODEL"]),
        "UA_OSCOMB": key(_SYSTEM),
        "UA_BROWSERCOMB": key(["UA_BROWSER", "UA_BROWSERVERSION"]),
        "INTENDENTISACTUALDEVICETYPE": (_DEVICE, keys.same(*_DEVICE)),
    }


_PROFILES = {"production": _production_features, "spark": _spark_features, "explore": _explore_features}


def add_features(df: DataFrame, profile: str) -> DataFrame:
    """Add the features of a set whose input columns are there, in one projection."""
    has = set(df.columns)
    features = _PROFILES[profile]()
    return df.withColumns({name: c for name, (reads, c) in features.items() if has.issuperset(reads)})


def inputs_of(profile: str, columns: list[str]) -> list[str]:
    """Raw columns that a list of raw and derived columns needs."""
    features = _PROFILES[profile]()
    return list(dict.fromkeys(r for c in columns for r in (features[c][0] if c in features else [c])))


def prepare(
    df: DataFrame,
    profile: str = "production",
    trim: float = K.NO_TRIM,
    scoring: bool = False,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Typed columns and features of the ``production`` or ``spark`` set.

    Scoring input never loses rows: the target is neither read nor trimmed.
    ``narrow`` may give the same rows with the raw target only; the percentile
    is then searched there, without the joins behind ``df``.
    """
    typed = _numbered(df, scoring)
    if not scoring:
        typed = trim_above_percentile(typed, K.TARGET, trim, of=None if narrow is None else _numbered(narrow, scoring))
    return add_features(typed, profile)


def explore(
    df: DataFrame,
    trim: float = K.TRIM_EXPLORE,
    size_trim: float = K.TRIM_FILE_SIZE,
    time_after: int = K.TIME_AFTER,
    time_before: int = K.TIME_BEFORE,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """The exploration set: trims, range filters, underscore-joined keys, fewer columns.

    ``narrow`` may give the same rows with only the raw columns ``EXPLORE_TRIMS``;
    both percentiles are then searched there, without the joins behind ``df``.
    """

    def ranged(rows: DataFrame, limit: float | None) -> DataFrame:
        kept = keep_below(rows, K.TARGET, limit).withColumns(
            {"TOPMOSTREACHABLEWINDOWAREA": window_area(), "_size": files.image_size("FILESJSON", quoted=True)}
        )
        kept = keep_range(kept, "TOPMOSTREACHABLEWINDOWAREA", at_least=K.AREA_MIN, below=K.AREA_BELOW)
        return keep_range(kept, "TIMESTAMP", above=time_after, below=time_before)

    wide = _numbered(df, scoring=False)
    searched = wide if narrow is None else _numbered(narrow, scoring=False)
    limit = percentile_limit(searched, K.TARGET, trim)
    size_limit = percentile_limit(ranged(searched, limit), "_size", size_trim)
    kept = keep_below(ranged(wide, limit), "_size", size_limit)
    return add_features(kept, "explore").drop("_size", *K.EXPLORE_DROPPED)
