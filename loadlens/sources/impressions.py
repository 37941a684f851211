"""Impression log derived from the relational test tables.

Gives the raw all-text layout that the engine works on, with null literals,
hollow composite keys, negative window sizes and differing device types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_RULES = {
    "IMPRESSION_ID": "event_id",
    "ADLOADINGTIME": "if(event_id % 97 = 0, 'null', cast(value as string))",
    "TIMESTAMP": "cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as string)",
    "ACCOUNTID": "cast(user_id % 7 as string)",
    "CAMPAIGNID": "cast(user_id % 20 as string)",
    "CREATIVEID": "cast(user_id as string)",
    "PLACEMENTID": "cast(event_id % 40 as string)",
    "SDK": "if(event_id % 4 = 0, 'MRAID', 'Web')",
    "CREATIVETYPE": "event_type",
    "EXTERNALADSERVER": "if(event_id % 5 = 0, 'null', concat('srv', event_id % 3))",
    "EXTERNALPLACEMENTID": "if(event_id % 5 = 0, 'null', concat('pl', event_id % 11))",
    "EXTERNALSITEID": "if(event_id % 10 < 6, 'null', concat('st', event_id % 6))",
    "EXTERNALSUPPLIERID": "if(event_id % 15 < 11, 'null', concat('sp', event_id % 4))",
    "PLATFORM": "case user_id % 3 when 2 then 'null' when 1 then 'Android' else 'iOS' end",
    "PLATFORMVERSION": "if(user_id % 3 = 2, 'null', cast(user_id % 4 + 6 as string))",
    "UA_OS": "if(user_id % 3 = 1, 'Android', 'iOS')",
    "UA_OSVERSION": "if(user_id % 8 = 0, 'null', cast(user_id % 4 + 6 as string))",
    "UA_VENDOR": "p_brand",
    "UA_MODEL": "p_name",
    "UA_HARDWARETYPE": "p_type",
    "UA_BROWSER": "if(user_id % 2 = 0, 'Safari', 'Chrome')",
    "UA_BROWSERVERSION": "cast(user_id % 9 + 40 as string)",
    "INTENDEDDEVICETYPE": "if(user_id % 2 = 0, 'Phone', 'Tablet')",
    "ACTUALDEVICETYPE": "if(user_id % 5 = 0, 'Tablet', 'Phone')",
    "UA_MOBILEDEVICE": "if(event_id % 17 = 0, 'null', '1')",
    "GEOIP_COUNTRY": "if(c_nationkey = 0, 'United States', n_name)",
    "GEOIP_REGION": "r_name",
    "GEOIP_LAT": "if(event_id % 23 = 0, 'null', cast(c_nationkey - 12 as string))",
    "GEOIP_LNG": "if(event_id % 23 = 0, 'null', concat(c_nationkey * 7, '.5'))",
    "GEOIP_CITY": "concat('city', user_id % 12)",
    "GEOIP_AREACODE": "if(event_id % 3 = 0, 'null', cast(200 + user_id % 8 as string))",
    "GEOIP_DMACODE": "if(user_id % 4 = 0, 'null', cast(500 + user_id % 15 as string))",
    "GEOIP_METROCODE": "if(user_id % 4 = 0, 'null', cast(500 + user_id % 15 as string))",
    "GEOIP_TIMEZONE": "concat('UTC+', event_id % 6)",
    "CDNNAME": "concat('cdn', event_id % 4)",
    "NETWORKTYPE": "if(event_id % 9 > 0, 'null', 'wifi')",
    "DEVICEORIENTATION": "if(event_id % 8 < 3, '90', '0')",
    "EXTERNALCREATIVEID": "'null'",
    "UA_BROWSERRENDERINGENGINE": "if(user_id % 2 = 0, 'WebKit', if(event_id % 7 = 0, 'Gecko', 'Blink'))",
    "UA_DEVICETYPE": "if(user_id % 5 = 0, 'Tablet', 'Phone')",
    "UA_PLATFORM": "case user_id % 3 when 2 then 'null' when 1 then 'Android' else 'iOS' end",
    "UA_PLATFORMVERSION": "if(user_id % 3 = 2, 'null', cast(user_id % 4 + 6 as string))",
    "HOSTWINDOWHEIGHT": "if(event_id % 19 = 0, 'null', cast(event_id % 1300 as string))",
    "HOSTWINDOWWIDTH": "if(event_id % 19 = 0, 'null', cast(event_id % 900 as string))",
    "TOPMOSTREACHABLEWINDOWWIDTH": "if(event_id % 13 = 0, 'null', cast(event_id % 3000 - 5 as string))",
    "TOPMOSTREACHABLEWINDOWHEIGHT": "cast(event_id % 4500 as string)",
    "FILESJSON": """case event_type
        when 'error' then '[]'
        when 'view' then concat('[{"type":"image","size":', user_id * 10, '}]')
        else concat('[{"type":"image","size":', user_id * 10, '},{"type":"video","size":', event_id % 50, '}]') end""",
    "ERRORSJSON": "if(event_type = 'error', '[\"timeout\"]', '[]')",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Columns that need a join; the joins are one to one on the right-hand key.
_FROM_PART = {"UA_VENDOR", "UA_MODEL", "UA_HARDWARETYPE"}
_FROM_CUSTOMER = {"GEOIP_LAT", "GEOIP_LNG"}
_FROM_NATION = {"GEOIP_COUNTRY", "GEOIP_REGION"}


def impressions(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """One row per event, all columns or the named ones.

    Only the tables behind the wanted columns are joined: the optimiser cannot
    know that the keys are unique and would keep a join nobody reads. Its
    strategy is left to the optimiser.
    """
    wanted = list(columns or _RULES)
    need = set(wanted)
    df = table(spark, folder, "events")
    if need & _FROM_PART:
        df = df.join(table(spark, folder, "part"), on=_equal("user_id", "p_partkey"), how="left")
    if need & (_FROM_CUSTOMER | _FROM_NATION):
        people = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        df = df.join(people, on=_equal("user_id", "c_custkey"), how="left")
    if need & _FROM_NATION:
        places = table(spark, folder, "nation").join(
            table(spark, folder, "region"), on=_equal("n_regionkey", "r_regionkey"), how="left"
        )
        df = df.join(places, on=_equal("c_nationkey", "n_nationkey"), how="left")
    return df.selectExpr(*[f"{_RULES[name]} as {name}" for name in wanted])


def _equal(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)
