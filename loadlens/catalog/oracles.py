"""SQL for DuckDB that gives the rows of the registered queries.

Written from the meaning of each query, not from its Spark plan.
"""

from __future__ import annotations

from loadlens import constants as K
from loadlens.catalog.queries import AFTER, BEFORE, CAP, MIDDLE, PER_BIN, REMAINING, SLOW, WIDTH, _list_sets

# Raw impression log over the relational tables; every column but the key is text.
_ADS = """
ads AS (
  SELECT event_id AS IMPRESSION_ID,
    CASE WHEN event_id % 97 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END AS ADLOADINGTIME,
    CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS "TIMESTAMP",
    CAST(user_id % 7 AS VARCHAR) AS ACCOUNTID,
    CAST(user_id % 20 AS VARCHAR) AS CAMPAIGNID,
    CAST(user_id AS VARCHAR) AS CREATIVEID,
    CAST(event_id % 40 AS VARCHAR) AS PLACEMENTID,
    CASE WHEN event_id % 4 = 0 THEN 'MRAID' ELSE 'Web' END AS SDK,
    event_type AS CREATIVETYPE,
    CASE WHEN event_id % 5 = 0 THEN 'null' ELSE 'srv' || (event_id % 3) END AS EXTERNALADSERVER,
    CASE WHEN event_id % 5 = 0 THEN 'null' ELSE 'pl' || (event_id % 11) END AS EXTERNALPLACEMENTID,
    CASE WHEN event_id % 10 < 6 THEN 'null' ELSE 'st' || (event_id % 6) END AS EXTERNALSITEID,
    CASE WHEN event_id % 15 < 11 THEN 'null' ELSE 'sp' || (event_id % 4) END AS EXTERNALSUPPLIERID,
    CASE user_id % 3 WHEN 2 THEN 'null' WHEN 1 THEN 'Android' ELSE 'iOS' END AS PLATFORM,
    CASE WHEN user_id % 3 = 2 THEN 'null' ELSE CAST(user_id % 4 + 6 AS VARCHAR) END AS PLATFORMVERSION,
    CASE WHEN user_id % 3 = 1 THEN 'Android' ELSE 'iOS' END AS UA_OS,
    CASE WHEN user_id % 8 = 0 THEN 'null' ELSE CAST(user_id % 4 + 6 AS VARCHAR) END AS UA_OSVERSION,
    p_brand AS UA_VENDOR, p_name AS UA_MODEL, p_type AS UA_HARDWARETYPE,
    CASE WHEN user_id % 2 = 0 THEN 'Safari' ELSE 'Chrome' END AS UA_BROWSER,
    CAST(user_id % 9 + 40 AS VARCHAR) AS UA_BROWSERVERSION,
    CASE WHEN user_id % 2 = 0 THEN 'Phone' ELSE 'Tablet' END AS INTENDEDDEVICETYPE,
    CASE WHEN user_id % 5 = 0 THEN 'Tablet' ELSE 'Phone' END AS ACTUALDEVICETYPE,
    CASE WHEN event_id % 17 = 0 THEN 'null' ELSE '1' END AS UA_MOBILEDEVICE,
    CASE WHEN c_nationkey = 0 THEN 'United States' ELSE n_name END AS GEOIP_COUNTRY,
    r_name AS GEOIP_REGION,
    CASE WHEN event_id % 23 = 0 THEN 'null' ELSE CAST(c_nationkey - 12 AS VARCHAR) END AS GEOIP_LAT,
    CASE WHEN event_id % 23 = 0 THEN 'null' ELSE CAST(c_nationkey * 7 AS VARCHAR) || '.5' END AS GEOIP_LNG,
    'city' || (user_id % 12) AS GEOIP_CITY,
    CASE WHEN event_id % 3 = 0 THEN 'null' ELSE CAST(200 + user_id % 8 AS VARCHAR) END AS GEOIP_AREACODE,
    CASE WHEN user_id % 4 = 0 THEN 'null' ELSE CAST(500 + user_id % 15 AS VARCHAR) END AS GEOIP_DMACODE,
    CASE WHEN user_id % 4 = 0 THEN 'null' ELSE CAST(500 + user_id % 15 AS VARCHAR) END AS GEOIP_METROCODE,
    'UTC+' || (event_id % 6) AS GEOIP_TIMEZONE,
    'cdn' || (event_id % 4) AS CDNNAME,
    CASE WHEN event_id % 9 > 0 THEN 'null' ELSE 'wifi' END AS NETWORKTYPE,
    CASE WHEN event_id % 8 < 3 THEN '90' ELSE '0' END AS DEVICEORIENTATION,
    'null' AS EXTERNALCREATIVEID,
    CASE WHEN user_id % 2 = 0 THEN 'WebKit' WHEN event_id % 7 = 0 THEN 'Gecko' ELSE 'Blink' END AS UA_BROWSERRENDERINGENGINE,
    CASE WHEN user_id % 5 = 0 THEN 'Tablet' ELSE 'Phone' END AS UA_DEVICETYPE,
    CASE user_id % 3 WHEN 2 THEN 'null' WHEN 1 THEN 'Android' ELSE 'iOS' END AS UA_PLATFORM,
    CASE WHEN user_id % 3 = 2 THEN 'null' ELSE CAST(user_id % 4 + 6 AS VARCHAR) END AS UA_PLATFORMVERSION,
    CASE WHEN event_id % 19 = 0 THEN 'null' ELSE CAST(event_id % 1300 AS VARCHAR) END AS HOSTWINDOWHEIGHT,
    CASE WHEN event_id % 19 = 0 THEN 'null' ELSE CAST(event_id % 900 AS VARCHAR) END AS HOSTWINDOWWIDTH,
    CASE WHEN event_id % 13 = 0 THEN 'null' ELSE CAST(event_id % 3000 - 5 AS VARCHAR) END AS TOPMOSTREACHABLEWINDOWWIDTH,
    CAST(event_id % 4500 AS VARCHAR) AS TOPMOSTREACHABLEWINDOWHEIGHT,
    CASE event_type WHEN 'error' THEN '[]'
      WHEN 'view' THEN '[{"type":"image","size":' || (user_id * 10) || '}]'
      ELSE '[{"type":"image","size":' || (user_id * 10) || '},{"type":"video","size":' || (event_id % 50) || '}]'
      END AS FILESJSON,
    CASE WHEN event_type = 'error' THEN '["timeout"]' ELSE '[]' END AS ERRORSJSON
  FROM events
  LEFT JOIN part ON p_partkey = user_id
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
)"""


def _number(c: str, kind: str) -> str:
    return f"CAST(CASE WHEN \"{c}\" = 'null' THEN '0' ELSE \"{c}\" END AS {kind}) AS \"{c}\""


_TYPED = (
    "typed AS (SELECT * REPLACE ("
    + ", ".join([_number(c, "DOUBLE") for c in K.DOUBLE_COLUMNS] + [_number(c, "BIGINT") for c in K.LONG_COLUMNS])
    + ") FROM ads)"
)

_AREA = "TOPMOSTREACHABLEWINDOWWIDTH * TOPMOSTREACHABLEWINDOWHEIGHT"
_PLACE = """CASE WHEN contains(split_part(GEOIP_COUNTRY, '_', 1), 'United States')
    THEN GEOIP_COUNTRY || '_' || GEOIP_REGION ELSE split_part(GEOIP_COUNTRY, '_', 1) END"""


def _unquoted(c: str) -> str:
    return f"replace({c}, '\"', '')"


def _tokens(text: str, lead: str) -> str:
    bare = f"replace(replace(replace(replace({text}, '[', ''), '}}', ''), ']', ''), '{lead}', '')"
    sizes = f"[CAST(t AS BIGINT) FOR t IN string_split({bare}, ',') IF regexp_full_match(t, '[0-9]+')]"
    return f"CAST(coalesce(list_sum({sizes}), 0) AS BIGINT)"


_IMAGE = _tokens(_unquoted("FILESJSON"), "{type:image,size:")
_VIDEO = _tokens(_unquoted("FILESJSON"), "{type:video,size:")
_IMAGE_QUOTED = _tokens("FILESJSON", '{"type":"image","size":')
_TOTAL = (
    "CAST(coalesce(list_sum([CAST(t AS BIGINT) FOR t IN "
    "string_split(regexp_replace(FILESJSON, '[^,0-9]', '', 'g'), ',') IF t <> '']), 0) AS BIGINT)"
)
_PLATFORM = """CASE WHEN replace(PLATFORM || PLATFORMVERSION, 'null', '') = '' THEN 'NA'
    ELSE replace(PLATFORM || PLATFORMVERSION, 'null', '') END"""

_PRODUCTION = f"""
production AS (
  SELECT * REPLACE ({_PLACE} AS GEOIP_COUNTRY, {_unquoted("ERRORSJSON")} AS ERRORSJSON, {_unquoted("FILESJSON")} AS FILESJSON),
    {_AREA} AS TOPMOSTREACHABLEWINDOWAREA,
    {_IMAGE} AS FILESJSON_IMGSIZE, {_VIDEO} AS FILESJSON_VIDSIZE,
    ACCOUNTID || CAMPAIGNID || CREATIVEID AS COMBINEDID,
    EXTERNALPLACEMENTID || EXTERNALSITEID || EXTERNALSUPPLIERID AS COMBINEDEXTERNALID,
    {_PLATFORM} AS PLATFORMCOMBINED,
    UA_OS || UA_OSVERSION AS UA_OSCOMB,
    INTENDEDDEVICETYPE = ACTUALDEVICETYPE AS INTENDENTISACTUALDEVICETYPE,
    ({_PLATFORM}) = UA_OS || UA_OSVERSION AS PLATFORMCOMBINEDISOSCAOMB
  FROM typed)"""


def _bare(*names: str) -> str:
    return " || ".join(f"replace({n}, 'null', '')" for n in names)


_SPARK = f"""
spark AS (
  SELECT *, {_AREA} AS TOPMOSTREACHABLEWINDOWAREA,
    ACCOUNTID || CAMPAIGNID || CREATIVEID || SDK AS COMBINEDID,
    {_bare("EXTERNALADSERVER", "EXTERNALPLACEMENTID", "EXTERNALSITEID", "EXTERNALSUPPLIERID")} AS COMBINEDEXTERNALID,
    {_bare("PLATFORM", "PLATFORMVERSION")} AS PLATFORMCOMBINED,
    {_bare("UA_OS", "UA_OSVERSION")} AS UA_OSCOMB,
    {_TOTAL} AS FILESJSON_SIZE
  FROM typed)"""

_EXTERNAL = "EXTERNALPLACEMENTID || '_' || EXTERNALSITEID || '_' || EXTERNALSUPPLIERID"
_IDS = "SDK || '_' || ACCOUNTID || '_' || CAMPAIGNID || '_' || CREATIVEID || '_' || EXTERNALADSERVER"
_EXPLORE_COLUMNS = f"""{_IDS} AS COMBINEDID, {_IDS} || '_' || PLACEMENTID AS COMBINEDIDWITHPLACEMENTID,
    CASE WHEN {_EXTERNAL} IN ('null_null', 'null_null_null') THEN 'null' ELSE {_EXTERNAL} END AS COMBINEDEXTERNALID,
    PLATFORM || '_' || PLATFORMVERSION AS PLATFORMCOMBINED,
    UA_VENDOR || '_' || UA_MODEL AS UA_VENDORMODEL,
    UA_OS || '_' || UA_OSVERSION AS UA_OSCOMB,
    UA_BROWSER || '_' || UA_BROWSERVERSION AS UA_BROWSERCOMB"""

_PART = "(CAST('0x' || substr(md5(CAST(IMPRESSION_ID AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 500)"
_SEGMENT = ", ".join(K.SEGMENT_KEYS)
_WIDE = ", ".join(K.SEGMENT_KEYS_WIDE)

# Bins of the target: edges 0, w, 2w, … below the rounded maximum.
_NEAREST = f"CAST(least(greatest(ceil(y / {WIDTH} - 0.5), 0), n_edges - 1) AS BIGINT)"
_INSIDE = f"CAST(least(floor(y / {WIDTH}), n_edges - 2) AS BIGINT)"


def _edges(source: str, value: str = "ADLOADINGTIME", rounding: str = "ceil") -> str:
    return f"edges AS (SELECT CAST(ceil({rounding}(max({value})) / {WIDTH}) AS BIGINT) AS n_edges FROM {source})"


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _raw(body: str, *ctes: str) -> str:
    return _sql(body, _ADS, *ctes)


def _typed(body: str, *ctes: str) -> str:
    return _sql(body, _ADS, _TYPED, *ctes)


def _prod(body: str, *ctes: str) -> str:
    return _sql(body, _ADS, _TYPED, _PRODUCTION, *ctes)


def _spread(keys: str, value: str, digits: int = 4) -> str:
    return (
        f"{keys}, count(*) AS n, round(avg({value}), {digits}) AS mean, round(quantile_cont({value}, 0.5), 4) AS median, "
        f"round(stddev_pop({value}), 4) AS std"
    )


def _dense(bins: str, counts: str, columns: str) -> str:
    return f"""SELECT bin, CAST(bin * {WIDTH} AS DOUBLE) AS lower, {columns}
    FROM (SELECT unnest(generate_series(0, n_edges - {bins})) AS bin FROM edges)
    LEFT JOIN ({counts}) USING (bin)"""


def _error_profile(scored: str) -> str:
    return f"""SELECT bin, CAST(bin * {WIDTH} AS DOUBLE) AS edge, coalesce(n, 0) AS n, round(total / n, 4) AS mean_abs_error
    FROM (SELECT unnest(generate_series(0, n_edges - 1)) AS bin FROM edges)
    LEFT JOIN (SELECT {_NEAREST} AS bin, count(*) AS n, sum(abs(y - p)) AS total FROM {scored}, edges GROUP BY 1) USING (bin)"""


def _rebalance(mode: str) -> str:
    measure = "coalesce(h.n, 0)" if mode == "compat" else "b.n"
    more = 1 if mode == "compat" else 0
    last = "TRUE" if mode == "clean" else f"(bin < {K.REBALANCE_WHOLE_BINS} OR bin < n_edges - 1)"
    return _typed(
        f"""SELECT IMPRESSION_ID, bin, CAST(copies AS BIGINT) AS copies FROM (
          SELECT IMPRESSION_ID, bin, CASE
            WHEN bin < {K.REBALANCE_WHOLE_BINS} THEN 1
            WHEN NOT {last} THEN 0
            WHEN m > {PER_BIN} THEN 1
            WHEN m = 0 THEN 0
            ELSE {PER_BIN} // m + CASE WHEN {PER_BIN} % m > 0 AND rn <= {PER_BIN} % m + {more} THEN 1 ELSE 0 END
            END AS copies
          FROM ranked) WHERE copies > 0""",
        _edges("typed"),
        f"""placed AS (SELECT IMPRESSION_ID, {_NEAREST} AS bin, n_edges,
            CASE WHEN y BETWEEN 0 AND (n_edges - 1) * {WIDTH} THEN {_INSIDE} END AS inside
          FROM (SELECT IMPRESSION_ID, ADLOADINGTIME AS y FROM typed), edges)""",
        "h AS (SELECT inside AS bin, count(*) AS n FROM placed WHERE inside IS NOT NULL GROUP BY 1)",
        "b AS (SELECT bin, count(*) AS n FROM placed GROUP BY 1)",
        f"""ranked AS (SELECT IMPRESSION_ID, placed.bin, n_edges, {measure} AS m,
            row_number() OVER (PARTITION BY placed.bin ORDER BY IMPRESSION_ID) AS rn
          FROM placed JOIN b ON b.bin = placed.bin LEFT JOIN h ON h.bin = placed.bin)""",
    )


def _by_label(source: str, feature: str, train: str = "train") -> str:
    """Least squares on one categorical feature: the group mean; an unseen label
    counts as the most frequent one."""
    return f"""SELECT '{feature}' AS name, count(*) AS n,
      round(sqrt(avg(power(y - coalesce(g.m, r.m), 2))), 4) AS rmse
    FROM (SELECT {feature} AS f, ADLOADINGTIME AS y FROM {source} WHERE NOT train) t
    LEFT JOIN (SELECT {feature} AS f, avg(ADLOADINGTIME) AS m FROM {source} WHERE {train} GROUP BY 1) g USING (f),
    (SELECT avg(ADLOADINGTIME) AS m FROM {source} WHERE {train} GROUP BY {feature}
     ORDER BY count(*) DESC, {feature} LIMIT 1) r"""


def _within(number: str) -> str:
    """Least squares on PLACEMENTID plus one number: group means and a common slope."""
    return f"""SELECT '{number}' AS name, count(*) AS n, round(sqrt(avg(power(y - (my + b * (x - mx)), 2))), 4) AS rmse
    FROM (SELECT PLACEMENTID, ADLOADINGTIME AS y, CAST({number} AS DOUBLE) AS x FROM halves WHERE NOT train)
    JOIN (SELECT PLACEMENTID, avg(ADLOADINGTIME) AS my, avg({number}) AS mx FROM halves WHERE train GROUP BY 1) USING (PLACEMENTID),
    (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS b
     FROM (SELECT ADLOADINGTIME AS y, CAST({number} AS DOUBLE) AS x,
             avg(ADLOADINGTIME) OVER (PARTITION BY PLACEMENTID) AS my,
             avg({number}) OVER (PARTITION BY PLACEMENTID) AS mx
           FROM halves WHERE train))"""


_DRAW = "CAST('0x' || substr(md5('1|' || IMPRESSION_ID), 1, 13) AS BIGINT)"
# Missing is NULL here: NaN and NULL mean the same.
_GAPPY = """gappy AS (SELECT CASE WHEN IMPRESSION_ID % 31 <> 0 THEN IMPRESSION_ID END AS id, CASE WHEN IMPRESSION_ID % 5 <> 0 THEN PLACEMENTID END AS place,
  CASE WHEN IMPRESSION_ID % 7 <> 0 THEN IMPRESSION_ID % 2 = 0 END AS flag,
  CASE WHEN IMPRESSION_ID % 11 <> 0 AND IMPRESSION_ID % 13 <> 0 THEN ADLOADINGTIME END AS y,
  CASE WHEN IMPRESSION_ID % 17 <> 0 AND IMPRESSION_ID % 19 <> 0 THEN sqrt(abs(ADLOADINGTIME)) + 1 END AS p FROM typed)"""
_TRIMMED = f"""halves AS (SELECT *, {_PART} AS train FROM {{source}}
  WHERE ADLOADINGTIME < (SELECT quantile_cont(ADLOADINGTIME, 0.9525) FROM typed))"""


def _forest_facts(trees: int, depth: int) -> str:
    return f"""SELECT {trees}::INTEGER AS trees, {depth}::INTEGER AS wanted_depth, {min(depth, 30)}::INTEGER AS depth,
      count(*) AS n, round(stddev_pop(ADLOADINGTIME), 4) AS baseline, TRUE AS all_in_range FROM halves WHERE NOT train"""


_HALVES = f"halves AS (SELECT *, {_PART} AS train FROM production)"
_SLOW_KEYS = f"slow AS (SELECT {_SEGMENT} FROM production GROUP BY ALL HAVING quantile_cont(ADLOADINGTIME, 0.5) > {SLOW})"
_IS_SLOW = f"({_SEGMENT}) IN (SELECT ({_SEGMENT}) FROM slow)"


_REMAINING_NUMBERS = [c for c in REMAINING if c in K.DOUBLE_COLUMNS + K.LONG_COLUMNS]
# Every device column is a function of the user and so of the joint id: it cannot lower the error.
_DEVICE_LISTS = [
    [],
    ["UA_VENDOR"],
    ["UA_MODEL"],
    ["UA_OS"],
    ["UA_OSVERSION"],
    ["UA_BROWSERVERSION"],
    ["UA_BROWSER"],
    ["UA_VENDOR", "UA_MODEL"],
    ["UA_OS", "UA_OSVERSION"],
    ["UA_BROWSERVERSION", "UA_BROWSER"],
    ["UA_VENDORMODEL"],
    ["UA_OSCOMB"],
    ["UA_BROWSERCOMB"],
]
_EXPLORE_HALVES = f"""halves AS (SELECT *, {_PART} AS train FROM (
  SELECT * REPLACE ({_PLACE} AS GEOIP_COUNTRY, {_unquoted('ERRORSJSON')} AS ERRORSJSON), {_EXPLORE_COLUMNS},
    INTENDEDDEVICETYPE = ACTUALDEVICETYPE AS INTENDENTISACTUALDEVICETYPE FROM typed))"""


def _added_to(base: str, texts: list[str], numbers: list[str], sweeps: int) -> str:
    """Least squares on a text column alone, with one more text, and with one number.

    Two texts are fitted by alternating group means until they stand still; a
    number by its slope within the labels of the base. An unseen label counts
    as the most frequent one of its column.
    """
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS name, {base} AS a, CAST({c} AS VARCHAR) AS b, ADLOADINGTIME AS y, train FROM halves" for c in texts
    )
    lines = " UNION ALL ".join(
        f"SELECT '{c}' AS name, {base} AS a, CAST(\"{c}\" AS DOUBLE) AS x, ADLOADINGTIME AS y, train FROM halves" for c in numbers
    )
    steps = ["b0 AS (SELECT DISTINCT name, b, 0.0::DOUBLE AS v FROM cells)"]
    for k in range(1, sweeps + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT name, a, sum(s - n * v) / sum(n) AS v FROM cells JOIN b{k - 1} USING (name, b) GROUP BY ALL)")
        steps.append(f"b{k} AS MATERIALIZED (SELECT name, b, sum(s - n * v) / sum(n) AS v FROM cells JOIN a{k} USING (name, a) GROUP BY ALL)")
    usual = "SELECT name, {0}, row_number() OVER (PARTITION BY name ORDER BY sum(n) DESC, {0}) AS r FROM cells GROUP BY name, {0}"
    by_label = _by_label("halves", base).replace(f"'{base}' AS name", "'(base)' AS name")
    return f"""
      {by_label}
      UNION ALL SELECT * FROM (
        WITH obs AS ({rows}),
        cells AS MATERIALIZED (SELECT name, a, b, count(*) AS n, sum(y) AS s FROM obs WHERE train GROUP BY ALL),
        {", ".join(steps)},
        ua AS (SELECT name, v AS va FROM ({usual.format("a")}) JOIN a{sweeps} USING (name, a) WHERE r = 1),
        ub AS (SELECT name, v AS vb FROM ({usual.format("b")}) JOIN b{sweeps} USING (name, b) WHERE r = 1)
        SELECT name, count(*) AS n, round(sqrt(avg(power(y - coalesce(fa.v, va) - coalesce(fb.v, vb), 2))), 4) AS rmse
        FROM obs LEFT JOIN a{sweeps} AS fa USING (name, a) LEFT JOIN b{sweeps} AS fb USING (name, b) JOIN ua USING (name) JOIN ub USING (name)
        WHERE NOT train GROUP BY name)
      """ + (f"""UNION ALL SELECT * FROM (
        WITH obs AS ({lines}),
        means AS (SELECT name, a, avg(x) AS mx, avg(y) AS my, count(*) AS k FROM obs WHERE train GROUP BY ALL),
        slopes AS (SELECT name, CASE WHEN sum((x - mx) * (x - mx)) > 1e-9 * sum(x * x) THEN sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) ELSE 0 END AS b
          FROM obs JOIN means USING (name, a) WHERE train GROUP BY name),
        ua AS (SELECT name, mx AS ux, my AS uy FROM means QUALIFY row_number() OVER (PARTITION BY name ORDER BY k DESC, a) = 1)
        SELECT name, count(*) AS n, round(sqrt(avg(power(y - coalesce(my, uy) - b * (x - coalesce(mx, ux)), 2))), 4) AS rmse
        FROM obs LEFT JOIN means USING (name, a) JOIN slopes USING (name) JOIN ua USING (name) WHERE NOT train GROUP BY name)""" if numbers else "")


def _label_index(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS label, count(*) AS n, "
        f"CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS BIGINT) AS idx FROM {source} GROUP BY {c}"
        for c in columns
    )


_RAW_NAMES = [
    K.KEY,
    "ADLOADINGTIME",
    "TIMESTAMP",
    "ACCOUNTID",
    "CAMPAIGNID",
    "CREATIVEID",
    "PLACEMENTID",
    "SDK",
    "CREATIVETYPE",
    "EXTERNALADSERVER",
    "EXTERNALPLACEMENTID",
    "EXTERNALSITEID",
    "EXTERNALSUPPLIERID",
    "PLATFORM",
    "PLATFORMVERSION",
    "UA_OS",
    "UA_OSVERSION",
    "UA_VENDOR",
    "UA_MODEL",
    "UA_HARDWARETYPE",
    "UA_BROWSER",
    "UA_BROWSERVERSION",
    "INTENDEDDEVICETYPE",
    "ACTUALDEVICETYPE",
    "UA_MOBILEDEVICE",
    "GEOIP_COUNTRY",
    "GEOIP_REGION",
    "GEOIP_LAT",
    "GEOIP_LNG",
    "HOSTWINDOWHEIGHT",
    "HOSTWINDOWWIDTH",
    "TOPMOSTREACHABLEWINDOWWIDTH",
    "TOPMOSTREACHABLEWINDOWHEIGHT",
    "FILESJSON",
    "ERRORSJSON",
    "GEOIP_CITY",
    "GEOIP_AREACODE",
    "GEOIP_DMACODE",
    "GEOIP_METROCODE",
    "GEOIP_TIMEZONE",
    "CDNNAME",
    "NETWORKTYPE",
    "DEVICEORIENTATION",
    "EXTERNALCREATIVEID",
    "UA_BROWSERRENDERINGENGINE",
    "UA_DEVICETYPE",
    "UA_PLATFORM",
    "UA_PLATFORMVERSION",
]


def _profile(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE v = 'null') AS n_null_text,
      count(DISTINCT v) AS n_distinct, min(v) AS min_value, max(v) AS max_value,
      (SELECT v FROM (SELECT CAST("{c}" AS VARCHAR) AS v FROM ads) GROUP BY v ORDER BY count(*) DESC, v LIMIT 1) AS top_value,
      (SELECT count(*) AS k FROM ads GROUP BY "{c}" ORDER BY k DESC LIMIT 1) AS top_count,
      round(avg(TRY_CAST(v AS DOUBLE)), 4) AS mean, round(stddev_pop(TRY_CAST(v AS DOUBLE)), 4) AS std
    FROM (SELECT CAST("{c}" AS VARCHAR) AS v FROM ads)"""


_DROPPED = [
    "EXTERNALCREATIVEID",
    "NETWORKTYPE",
    "TOPMOSTREACHABLEWINDOWWIDTH",
    "TOPMOSTREACHABLEWINDOWHEIGHT",
    "HOSTWINDOWWIDTH",
    "HOSTWINDOWHEIGHT",
    "DEVICEORIENTATION",
    "UA_MOBILEDEVICE",
    "GEOIP_TIMEZONE",
    "GEOIP_METROCODE",
    "GEOIP_AREACODE",
    "GEOIP_CITY",
    "GEOIP_DMACODE",
    "GEOIP_REGION",
    "UA_PLATFORM",
    "UA_PLATFORMVERSION",
]


def all_oracles() -> dict[str, str]:
    group_mean = "scored AS (SELECT *, ADLOADINGTIME AS y, avg(ADLOADINGTIME) OVER (PARTITION BY PLACEMENTID) AS p FROM typed)"
    price = "l_extendedprice"
    sql = {
        "null_literal_cast": _typed(
            "SELECT IMPRESSION_ID, " + ", ".join(f'"{c}"' for c in K.DOUBLE_COLUMNS + K.LONG_COLUMNS) + " FROM typed"
        ),
        "null_text_replaced": _raw(
            "SELECT IMPRESSION_ID, replace(GEOIP_LAT, 'null', '0') AS lat_text, "
            "replace(PLATFORM, 'null', '') AS platform_text FROM ads"
        ),
        "range_filters": _typed(
            f'SELECT IMPRESSION_ID, {_AREA} AS TOPMOSTREACHABLEWINDOWAREA, "TIMESTAMP" FROM typed '
            f'WHERE {_AREA} >= 0 AND {_AREA} < 10000000 AND "TIMESTAMP" > {AFTER} AND "TIMESTAMP" < {BEFORE}'
        ),
        "audit_counts": _typed(
            f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_AREA} < 0) AS n_area_negative, count(*) FILTER (WHERE {_AREA} > 10000000) AS n_area_over, "
            f'count(*) FILTER (WHERE "TIMESTAMP" <= {AFTER}) AS n_early, count(*) FILTER (WHERE "TIMESTAMP" >= {BEFORE}) AS n_late FROM typed'
        ),
        "hard_cap": _typed(f"SELECT IMPRESSION_ID, ADLOADINGTIME FROM typed WHERE ADLOADINGTIME < {CAP}"),
        "null_key_filter": _raw(
            "SELECT IMPRESSION_ID, PLATFORM || '_' || PLATFORMVERSION AS PLATFORMCOMBINED FROM ads "
            "WHERE NOT (PLATFORM = 'null' AND PLATFORMVERSION = 'null')"
        ),
        "trim_percentiles": _typed(
            "SELECT percent, round(q, 4) AS threshold, count(*) FILTER (WHERE ADLOADINGTIME < q) AS n_kept FROM typed, limits GROUP BY percent, q",
            "limits AS ("
            + " UNION ALL ".join(
                f"SELECT CAST({p} AS DOUBLE) AS percent, quantile_cont(ADLOADINGTIME, {p} / 100.0) AS q FROM typed"
                for p in (K.TRIM_EXPLORE, K.TRIM_TRAIN, K.TRIM_VALIDATION, K.TRIM_FILE_SIZE)
            )
            + ")",
        ),
        "trim_line_items": f"""SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg({price}), 4) AS mean_price,
            max({price}) AS max_price FROM lineitem
            WHERE {price} < (SELECT quantile_cont({price}, 0.9525) FROM lineitem) GROUP BY ALL""",
        "combined_ids_explore": _raw(f"SELECT IMPRESSION_ID, {_EXPLORE_COLUMNS} FROM ads"),
        "combined_ids_production": _prod(
            "SELECT IMPRESSION_ID, COMBINEDID, COMBINEDEXTERNALID, PLATFORMCOMBINED, UA_OSCOMB FROM production"
        ),
        "combined_ids_spark": _typed(
            "SELECT IMPRESSION_ID, COMBINEDID, COMBINEDEXTERNALID, PLATFORMCOMBINED, UA_OSCOMB FROM spark", _SPARK
        ),
        "geo_country_region": _raw(f"SELECT IMPRESSION_ID, {_PLACE} AS GEOIP_COUNTRY FROM ads"),
        "quote_strip": _raw(
            f"SELECT IMPRESSION_ID, {_unquoted('ERRORSJSON')} AS ERRORSJSON, {_unquoted('FILESJSON')} AS FILESJSON FROM ads"
        ),
        "file_sizes_tokens": _raw(
            f"SELECT IMPRESSION_ID, {_IMAGE} AS image_size, {_VIDEO} AS video_size, {_IMAGE_QUOTED} AS image_size_quoted FROM ads"
        ),
        "file_sizes_total": _raw(f"SELECT IMPRESSION_ID, {_TOTAL} AS total_size FROM ads"),
        "file_sizes_json": _raw(
            """SELECT IMPRESSION_ID,
              CAST(coalesce(sum(size) FILTER (WHERE kind = 'image'), 0) AS BIGINT) AS image_size,
              CAST(coalesce(sum(size) FILTER (WHERE kind = 'video'), 0) AS BIGINT) AS video_size,
              CAST(coalesce(sum(size), 0) AS BIGINT) AS total_size
            FROM ads LEFT JOIN (
              SELECT IMPRESSION_ID, f ->> 'type' AS kind, CAST(f ->> 'size' AS BIGINT) AS size
              FROM (SELECT IMPRESSION_ID, unnest(CAST(FILESJSON AS JSON[])) AS f FROM ads)) USING (IMPRESSION_ID)
            GROUP BY IMPRESSION_ID"""
        ),
        "equality_flags": _prod(
            "SELECT IMPRESSION_ID, INTENDENTISACTUALDEVICETYPE, CAST(INTENDENTISACTUALDEVICETYPE AS INTEGER) AS same_device_int, "
            "PLATFORMCOMBINEDISOSCAOMB FROM production"
        ),
        "prepare_production": _prod("SELECT * FROM production"),
        "prepare_spark": _typed(
            f"SELECT IMPRESSION_ID, ADLOADINGTIME, {', '.join(K.FEATURES_SPARK)} FROM spark "
            "WHERE ADLOADINGTIME < (SELECT quantile_cont(ADLOADINGTIME, 0.9525) FROM typed)".replace("TIMESTAMP", '"TIMESTAMP"'),
            _SPARK,
        ),
        "prepare_explore": _typed(
            f"SELECT * EXCLUDE (size, {', '.join(_DROPPED)}) REPLACE ({_PLACE} AS GEOIP_COUNTRY, "
            f"{_unquoted('ERRORSJSON')} AS ERRORSJSON), {_EXPLORE_COLUMNS}, "
            "INTENDEDDEVICETYPE = ACTUALDEVICETYPE AS INTENDENTISACTUALDEVICETYPE "
            "FROM ranged WHERE size < (SELECT quantile_cont(size, 0.99) FROM ranged)",
            f"""ranged AS (SELECT *, {_AREA} AS TOPMOSTREACHABLEWINDOWAREA, {_IMAGE_QUOTED} AS size FROM typed
              WHERE ADLOADINGTIME < (SELECT quantile_cont(ADLOADINGTIME, 0.95) FROM typed)
              AND {_AREA} >= 0 AND {_AREA} < 10000000 AND "TIMESTAMP" > {AFTER} AND "TIMESTAMP" < {BEFORE})""",
        ),
        "drop_columns": _raw(f"SELECT * EXCLUDE ({', '.join(_DROPPED)}, ERRORSJSON, FILESJSON) FROM ads"),
        "select_features": _raw(
            f"SELECT IMPRESSION_ID, {', '.join(K.FEATURES_LR)} FROM (SELECT * REPLACE ({_unquoted('ERRORSJSON')} AS ERRORSJSON), "
            f"{_EXPLORE_COLUMNS} FROM ads)".replace("TIMESTAMP", '"TIMESTAMP"')
        ),
        "constant_and_shift": _typed(
            f"SELECT IMPRESSION_ID, CAST({K.BASELINE_CONSTANT} AS DOUBLE) AS constant, round(ADLOADINGTIME + 0.3, 4) AS shifted FROM typed"
        ),
        "placement_stats": _typed(
            f"SELECT {_spread('PLACEMENTID', 'ADLOADINGTIME', 8)} FROM typed "
            "WHERE ADLOADINGTIME < (SELECT quantile_cont(ADLOADINGTIME, 0.95) FROM typed) GROUP BY PLACEMENTID"
        ),
        "group_divider_stats": _prod(
            f"SELECT {_WIDE}, count(*) AS n, round(quantile_cont(ADLOADINGTIME, 0.5), 4) AS median, "
            "round(stddev_pop(ADLOADINGTIME), 4) AS std FROM production GROUP BY ALL"
        ),
        "line_item_spread": f"SELECT {_spread('l_returnflag', price)} FROM lineitem GROUP BY l_returnflag",
        "feature_group_means": _prod(
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n, round(avg(ADLOADINGTIME), 6) AS mean FROM production GROUP BY {c}"
                for c in ("COMBINEDID", "PLACEMENTID", "FILESJSON", "PLATFORMCOMBINED", "UA_BROWSER")
            )
        ),
        "global_stats": _typed(
            "SELECT count(*) AS n_rows, round(avg(ADLOADINGTIME), 4) AS mean, max(ADLOADINGTIME) AS max, "
            "round(quantile_cont(ADLOADINGTIME, 0.5), 4) AS median FROM typed"
        ),
        "label_index": _typed(_label_index(K.FEATURES_SPARK_CATEGORICAL, "spark"), _SPARK),
        "encode_rows": _raw(
            "SELECT IMPRESSION_ID, m.idx AS _UA_MODEL, v.idx AS _UA_VENDOR FROM ads "
            "JOIN m ON m.label = UA_MODEL JOIN v ON v.label = UA_VENDOR",
            f"m AS ({_label_index(['UA_MODEL'], 'ads')})",
            f"v AS ({_label_index(['UA_VENDOR'], 'ads')})",
        ),
        "profile_columns": _raw(" UNION ALL ".join(_profile(c) for c in _RAW_NAMES)),
        "profile_sketched": _raw(
            'SELECT "column", n_rows, n_null_text, min_value, max_value, mean, std, TRUE AS distinct_close, TRUE AS top_close FROM ('
            + " UNION ALL ".join(_profile(c) for c in _RAW_NAMES)
            + ")"
        ),
        "baseline_rmse": _typed(
            "SELECT 'mean' AS baseline, count(*) AS n, round(avg(y), 4) AS mean, round(stddev_pop(y), 4) AS rmse FROM v "
            "UNION ALL SELECT 'constant', count(*), round(avg(y), 4), "
            f"round(sqrt(avg(power(y - {K.BASELINE_CONSTANT}, 2))), 4) FROM v",
            "v AS (SELECT ADLOADINGTIME AS y FROM typed)",
        ),
        "rmse_shifted": _typed(
            "SELECT count(*) AS n, round(sqrt(avg(power(y - p, 2))), 4) AS rmse, "
            "round(sqrt(avg(power(y - p - 0.3, 2))), 4) AS rmse_shifted, round(avg(abs(y - p)), 4) AS mean_abs_error FROM scored",
            group_mean,
        ),
        "hist_fixed": _typed(
            _dense(
                "2",
                f"SELECT {_INSIDE} AS bin, count(*) AS n FROM (SELECT ADLOADINGTIME AS y FROM typed), edges "
                f"WHERE y BETWEEN 0 AND (n_edges - 1) * {WIDTH} GROUP BY 1",
                "coalesce(n, 0) AS n_adloadingtime",
            ),
            _edges("typed"),
        ),
        "hist_overlay": _typed(
            _dense(
                "2",
                f"SELECT {_INSIDE} AS bin, count(*) FILTER (WHERE what = 'a') AS a, count(*) FILTER (WHERE what = 'p') AS p FROM pairs, edges "
                f"WHERE y BETWEEN 0 AND (n_edges - 1) * {WIDTH} GROUP BY 1",
                "coalesce(a, 0) AS n_adloadingtime, coalesce(p, 0) AS n_prediction",
            ),
            _edges("typed", rounding="trunc"),
            """pairs AS (SELECT 'a' AS what, ADLOADINGTIME AS y FROM typed
              UNION ALL SELECT 'p', avg(ADLOADINGTIME) OVER (PARTITION BY CREATIVEID) FROM typed)""",
        ),
        "hist_group_medians": _prod(
            _dense(
                "2",
                f"SELECT {_INSIDE} AS bin, count(*) AS n FROM medians, edges WHERE y BETWEEN 0 AND (n_edges - 1) * {WIDTH} GROUP BY 1",
                "coalesce(n, 0) AS n_median",
            ),
            f"medians AS (SELECT quantile_cont(ADLOADINGTIME, 0.5) AS y FROM production GROUP BY {_SEGMENT})",
            _edges("medians", "y"),
        ),
        "hist_group_means": _prod(
            f"""SELECT feature, b.bin, CAST(b.bin * {WIDTH} AS DOUBLE) AS lower, count(y) AS n
            FROM (SELECT unnest(generate_series(0, n_edges - 2)) AS bin FROM edges) b CROSS JOIN (SELECT DISTINCT feature FROM means) f
            LEFT JOIN (SELECT feature AS g, y, n_edges FROM means, edges) ON g = feature
              AND (y >= b.bin * {WIDTH} AND y < (b.bin + 1) * {WIDTH} OR b.bin = n_edges - 2 AND y = (n_edges - 1) * {WIDTH}) GROUP BY ALL""",
            "means AS ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, avg(ADLOADINGTIME) AS y FROM production GROUP BY {c}"
                for c in ("COMBINEDID", "PLACEMENTID", "FILESJSON", "PLATFORMCOMBINED", "UA_BROWSER")
            )
            + ")",
            _edges("means", "y"),
        ),
        "nearest_edges": _typed(
            f"SELECT IMPRESSION_ID, {_NEAREST} AS bin FROM (SELECT IMPRESSION_ID, ADLOADINGTIME AS y FROM typed), edges",
            _edges("typed"),
        ),
        "error_profile": _typed(_error_profile("scored"), group_mean, _edges("typed")),
        "error_profile_pooled": _typed(
            _error_profile("parts"),
            "parts AS (SELECT ADLOADINGTIME AS y, avg(ADLOADINGTIME) OVER (PARTITION BY SDK, PLACEMENTID) AS p FROM typed)",
            _edges("typed"),
        ),
        "hash_split": _raw(f"SELECT IMPRESSION_ID, CASE WHEN {_PART} THEN 'train' ELSE 'test' END AS part FROM ads"),
        "slow_group_keys": _prod(f"SELECT {_SEGMENT} FROM slow", _SLOW_KEYS),
        "slow_group_semi": _prod(
            f"SELECT IMPRESSION_ID, {_SEGMENT}, ADLOADINGTIME FROM production SEMI JOIN slow USING ({_SEGMENT})", _SLOW_KEYS
        ),
        "slow_group_anti": _prod(
            f"SELECT IMPRESSION_ID, {_SEGMENT}, ADLOADINGTIME FROM production ANTI JOIN slow USING ({_SEGMENT})", _SLOW_KEYS
        ),
        "slow_flag": _prod(
            f"SELECT IMPRESSION_ID, s IS NOT NULL AS is_slow FROM production LEFT JOIN (SELECT *, 1 AS s FROM slow) USING ({_SEGMENT})",
            _SLOW_KEYS,
        ),
        "segment_rmse_pooled": _prod(
            "SELECT coalesce(segment, 'pooled') AS segment, count(*) AS n, round(sqrt(avg(power(y - p, 2))), 4) AS rmse "
            "FROM scored GROUP BY ROLLUP (segment)",
            _SLOW_KEYS,
            f"""flagged AS (SELECT *, ADLOADINGTIME AS y, CASE WHEN s IS NULL THEN 'fast' ELSE 'slow' END AS segment
              FROM production LEFT JOIN (SELECT *, 1 AS s FROM slow) USING ({_SEGMENT}))""",
            "scored AS (SELECT segment, y, avg(y) OVER (PARTITION BY segment, PLACEMENTID) AS p FROM flagged)",
        ),
        "rebalance_compat": _rebalance("compat"),
        "rebalance_clean": _rebalance("clean"),
        "first_k_per_bin": _typed(
            f"""SELECT IMPRESSION_ID, y AS ADLOADINGTIME, bin FROM (
              SELECT IMPRESSION_ID, y, {_NEAREST} AS bin FROM (SELECT IMPRESSION_ID, ADLOADINGTIME AS y FROM typed), edges)
            QUALIFY row_number() OVER (PARTITION BY bin ORDER BY IMPRESSION_ID) <= 5""",
            _edges("typed"),
        ),
        "first_row": _raw("SELECT * FROM ads ORDER BY IMPRESSION_ID LIMIT 1"),
        "union_append": _typed(
            "SELECT IMPRESSION_ID, ADLOADINGTIME FROM typed UNION ALL "
            f"SELECT IMPRESSION_ID, ADLOADINGTIME FROM typed WHERE ADLOADINGTIME >= {CAP}"
        ),
        "tsv_roundtrip": _raw("SELECT * REPLACE (CAST(IMPRESSION_ID AS VARCHAR) AS IMPRESSION_ID) FROM ads"),
        "tsv_odd_texts": """SELECT CAST(p_partkey AS VARCHAR) AS PARTKEY, '  ' || p_name || ' ' AS BLANKS,
            '"' || p_brand || '\\n, ''\\' AS MARKS, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS GAPS FROM part""",
        "random_sample_check": _raw(
            "SELECT count(*) AS n_rows, count(DISTINCT IMPRESSION_ID) AS n_keys, CAST(0 AS BIGINT) AS n_wrong, TRUE AS share_held FROM ads"
        ),
        "random_halves_check": _raw(
            "SELECT count(*) AS n_rows, count(DISTINCT IMPRESSION_ID) AS n_keys, TRUE AS share_held FROM ads"
        ),
        "exact_sample": _typed(f"SELECT IMPRESSION_ID, ADLOADINGTIME FROM typed ORDER BY {_DRAW} LIMIT 1000"),
        "exact_halves": _raw(
            f"SELECT IMPRESSION_ID, ADLOADINGTIME, CASE WHEN row_number() OVER (ORDER BY {_DRAW}) <= (SELECT count(*) // 2 FROM ads) THEN 'train' ELSE 'test' END AS part FROM ads"
        ),
        "missing_in_measures": _typed(
            """SELECT 'rmse' AS measure, NULL::VARCHAR AS level, count(*) AS n, round(sqrt(avg(power(y - p, 2))), 4) AS value
               FROM gappy WHERE y IS NOT NULL AND p IS NOT NULL
            UNION ALL SELECT 'baseline', NULL, count(y), round(stddev_pop(y), 4) FROM gappy
            UNION ALL SELECT 'mean', place, count(y), round(avg(y), 4) FROM gappy GROUP BY place
            UNION ALL SELECT 'profile', CAST(bin AS VARCHAR), n, mean_abs_error FROM (""" + _error_profile("(SELECT * FROM gappy WHERE y IS NOT NULL AND p IS NOT NULL)") + ")",
            _GAPPY,
            _edges("gappy", "y"),
        ),
        "missing_in_splits": _typed(
            """SELECT 'hash' AS split, CASE WHEN CAST('0x' || substr(md5(coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) % 1000 < 500 THEN 0 ELSE 1 END::BIGINT AS part, count(*) AS n FROM gappy GROUP BY ALL
            UNION ALL SELECT 'flag', CASE WHEN flag THEN 1 ELSE 0 END, count(*) FROM gappy GROUP BY ALL
            UNION ALL SELECT kind, CASE WHEN s.place IS NULL AND s.slow IS NULL THEN 0 ELSE 1 END, count(*)
              FROM gappy g LEFT JOIN (SELECT place, TRUE AS slow FROM gappy GROUP BY place HAVING quantile_cont(y, 0.5) > """ + str(MIDDLE) + """) s ON s.place IS NOT DISTINCT FROM g.place AND s.slow,
              (VALUES ('slow'), ('marked')) AS k(kind) GROUP BY ALL""",
            _GAPPY,
        ),
        "tsv_mixed_headers": _raw(
            "SELECT CAST(IMPRESSION_ID AS VARCHAR) AS IMPRESSION_ID, ADLOADINGTIME, SDK, PLACEMENTID, "
            "CASE WHEN IMPRESSION_ID % 2 = 1 THEN CREATIVETYPE ELSE '' END AS CREATIVETYPE FROM ads"
        ),
        "train_validate_job": _typed(
            f"""SELECT 'train n_rows' AS measure, NULL::BIGINT AS bin, count(*) AS n FROM parts WHERE train
            UNION ALL SELECT 'train n_imputed', NULL, count(*) FILTER (WHERE IMPRESSION_ID % 97 = 0) FROM parts WHERE train
            UNION ALL SELECT 'train n_malformed', NULL, 0
            UNION ALL SELECT 'train n_kept', NULL, count(*) FROM parts WHERE train AND y < (SELECT quantile_cont(y, {K.TRIM_TRAIN} / 100.0) FROM parts WHERE train)
            UNION ALL SELECT 'validation n_rows', NULL, count(*) FROM parts WHERE NOT train
            UNION ALL SELECT 'validation n_imputed', NULL, count(*) FILTER (WHERE IMPRESSION_ID % 97 = 0) FROM parts WHERE NOT train
            UNION ALL SELECT 'validation n_malformed', NULL, 0
            UNION ALL SELECT 'validation n_kept', NULL, count(*) FROM scored
            UNION ALL SELECT 'judged', NULL, count(*) FROM scored
            UNION ALL SELECT 'histogram', b.bin, count(y) FROM (SELECT unnest(generate_series(0, 18)) AS bin) b
              LEFT JOIN scored ON (y >= b.bin * 10 AND y < b.bin * 10 + 10) OR (b.bin = 18 AND y = 190) GROUP BY b.bin
            UNION ALL SELECT 'profile', bin, n FROM ({_error_profile("(SELECT y, 0 AS p FROM scored)")})""",
            f"parts AS (SELECT IMPRESSION_ID, ADLOADINGTIME AS y, {_PART} AS train FROM typed)",
            f"scored AS (SELECT y FROM parts WHERE NOT train AND y < (SELECT quantile_cont(y, {K.TRIM_VALIDATION} / 100.0) FROM parts WHERE NOT train))",
            _edges("scored", "y"),
        ),
        "score_histogram": _raw("SELECT count(*) AS n_rows, count(*) AS n_scored, CAST(count(*) AS BIGINT) AS n_in_histogram FROM ads"),
        "measures_at_once": _typed(
            f"""SELECT 'error' AS measure, NULL::BIGINT AS bin, count(*) AS n, NULL::BIGINT AS n_prediction, round(sqrt(avg(power(y - p, 2))), 4) AS value FROM scored
            UNION ALL SELECT 'histogram', b.bin, count(*) FILTER (WHERE y >= b.bin * 10 AND y < b.bin * 10 + 10), count(*) FILTER (WHERE p >= b.bin * 10 AND p < b.bin * 10 + 10), b.bin * 10.0::DOUBLE
              FROM (SELECT unnest(generate_series(0, n_edges - 1)) AS bin FROM edges) b, scored GROUP BY b.bin
            UNION ALL SELECT 'profile', bin, n, NULL, mean_abs_error FROM ({_error_profile("scored")})""",
            group_mean,
            _edges("typed"),
        ),
        "predictions_roundtrip": _typed("SELECT IMPRESSION_ID, round(ADLOADINGTIME + 0.3, 4) AS prediction FROM typed"),
        "lr_single_numeric": f"""
            WITH halves AS (SELECT l_quantity AS x, {price} AS y,
              CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 500 AS train FROM lineitem),
            line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM halves WHERE train)
            SELECT count(*) AS n, round(sqrt(avg(power(y - (a + b * x), 2))), 4) AS rmse FROM halves, line WHERE NOT train""",
        "lr_single_categorical": _prod(
            "SELECT IMPRESSION_ID, round(m, 4) AS prediction FROM halves "
            "JOIN (SELECT PLACEMENTID, avg(ADLOADINGTIME) AS m FROM halves WHERE train GROUP BY 1) USING (PLACEMENTID) WHERE NOT train",
            _HALVES,
        ),
        "feature_comparison": _prod(
            " UNION ALL ".join(
                _by_label("halves", c)
                for c in ("COMBINEDID", "PLACEMENTID", "UA_VENDOR", "UA_MODEL", "UA_OS", "PLATFORMCOMBINED", "COMBINEDEXTERNALID")
            ),
            _HALVES,
        ),
        "ablation_scan": _prod(
            _by_label("halves", "PLACEMENTID").replace("'PLACEMENTID' AS name", "'(base)' AS name")
            + "".join(
                " UNION ALL " + _within(c)
                for c in ('"TIMESTAMP"', "TOPMOSTREACHABLEWINDOWAREA", "FILESJSON_IMGSIZE", "FILESJSON_VIDSIZE", "GEOIP_LNG")
            ).replace("'\"TIMESTAMP\"'", "'TIMESTAMP'"),
            _HALVES,
        ),
        "ablation_scan_text": _prod(_added_to("COMBINEDID", ["UA_BROWSERVERSION", "UA_VENDOR", "CREATIVETYPE"], [], 60), _HALVES),
        "ablation_every_column": _typed(
            _added_to("COMBINEDID", [c for c in REMAINING if c not in (*_REMAINING_NUMBERS, "COMBINEDID", "FILESJSON")], _REMAINING_NUMBERS, 150), _EXPLORE_HALVES
        ),
        "ablation_lists_check": _typed(
            " UNION ALL ".join(f"SELECT '{name}' AS name, n, 0.0::DOUBLE AS residual FROM judged" for name in _list_sets()),
            _EXPLORE_HALVES,
            "judged AS (SELECT count(*) AS n FROM halves WHERE NOT train)",
        ),
        "device_feature_sets": _typed(
            " UNION ALL ".join(_by_label("halves", "COMBINEDID").replace("'COMBINEDID' AS name", f"'{' and '.join(['COMBINEDID', *more])}' AS name") for more in _DEVICE_LISTS),
            _EXPLORE_HALVES,
        ),
        "null_key_exclusion": _typed(
            " UNION ALL ".join(
                f"SELECT *, '{label}' AS train_rows FROM ({_by_label('halves', c, train)})"
                for label, train in (("all", "train"), ("without key", "train AND PLATFORMCOMBINED <> 'null_null'"))
                for c in ("COMBINEDID", "PLATFORMCOMBINED")
            ),
            f"halves AS (SELECT *, {_PART} AS train FROM (SELECT *, {_EXPLORE_COLUMNS} FROM typed))",
        ),
        "segmented_models": _prod(
            "SELECT coalesce(segment, 'pooled') AS segment, count(*) AS n, round(sqrt(avg(power(y - p, 2))), 4) AS rmse "
            "FROM scored GROUP BY ROLLUP (segment)",
            _HALVES,
            f"""slow AS (SELECT PLACEMENTID, CREATIVETYPE, 1 AS s FROM halves WHERE train GROUP BY ALL
              HAVING quantile_cont(ADLOADINGTIME, 0.5) > {SLOW})""",
            f"""flagged AS (SELECT PLACEMENTID, train, ADLOADINGTIME AS y, CASE WHEN s IS NULL THEN 'fast' ELSE 'slow' END AS segment
              FROM halves LEFT JOIN slow USING (PLACEMENTID, CREATIVETYPE) WHERE ADLOADINGTIME < {CAP})""",
            "means AS (SELECT segment, PLACEMENTID, avg(y) AS m, count(*) AS k FROM flagged WHERE train GROUP BY ALL)",
            """usual AS (SELECT segment, m AS r FROM means
              QUALIFY row_number() OVER (PARTITION BY segment ORDER BY k DESC, PLACEMENTID) = 1)""",
            """scored AS (SELECT segment, y, coalesce(m, r) AS p FROM flagged
              LEFT JOIN means USING (segment, PLACEMENTID) JOIN usual USING (segment) WHERE NOT train)""",
        ),
        "forest_spark_full": _typed(_forest_facts(50, 25), _SPARK, _TRIMMED.format(source="spark")),
        "forest_train_full": _prod(_forest_facts(25, 50), _TRIMMED.format(source="production")),
        "segmented_forests_full": _prod(
            "SELECT segment, count(*) AS n, count(*) AS n_scored, round(stddev_pop(y), 4) AS baseline FROM flagged WHERE NOT train GROUP BY segment",
            _HALVES,
            f"""slow AS (SELECT PLACEMENTID, CREATIVETYPE, 1 AS s FROM halves WHERE train GROUP BY ALL
              HAVING quantile_cont(ADLOADINGTIME, 0.5) > {SLOW})""",
            f"""flagged AS (SELECT train, ADLOADINGTIME AS y, CASE WHEN s IS NULL THEN 'fast' ELSE 'slow' END AS segment
              FROM halves LEFT JOIN slow USING (PLACEMENTID, CREATIVETYPE) WHERE ADLOADINGTIME < {CAP})""",
        ),
        "rebalanced_forest_full": _prod(
            "SELECT count(*) AS n, count(*) AS n_scored, round(stddev_pop(ADLOADINGTIME), 4) AS baseline FROM halves WHERE NOT train", _HALVES
        ),
        "train_apply_roundtrip": _raw("SELECT IMPRESSION_ID, TRUE AS same FROM ads"),
    }
    return sql
