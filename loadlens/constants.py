"""Column names, feature lists and tuning values used across the package."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Names and numbers that the input format and the expected
# results prescribe.
# ---------------------------------------------------------------------------

KEY = "IMPRESSION_ID"
TARGET = "ADLOADINGTIME"
NULL_TEXT = "null"

RAW_COLUMNS = [
    "ACCOUNTID",
    "ACTUALDEVICETYPE",
    "ADLOADINGTIME",
    "CAMPAIGNID",
    "CDNNAME",
    "CREATIVEID",
    "CREATIVETYPE",
    "DEVICEORIENTATION",
    "ERRORSJSON",
    "EXTERNALADSERVER",
    "EXTERNALCREATIVEID",
    "EXTERNALPLACEMENTID",
    "EXTERNALSITEID",
    "EXTERNALSUPPLIERID",
    "FILESJSON",
    "GEOIP_AREACODE",
    "GEOIP_CITY",
    "GEOIP_COUNTRY",
    "GEOIP_DMACODE",
    "GEOIP_LAT",
    "GEOIP_LNG",
    "GEOIP_METROCODE",
    "GEOIP_REGION",
    "GEOIP_TIMEZONE",
    "HOSTWINDOWHEIGHT",
    "HOSTWINDOWWIDTH",
    "INTENDEDDEVICETYPE",
    "NETWORKTYPE",
    "PLACEMENTID",
    "PLATFORM",
    "PLATFORMVERSION",
    "SDK",
    "TIMESTAMP",
    "TOPMOSTREACHABLEWINDOWHEIGHT",
    "TOPMOSTREACHABLEWINDOWWIDTH",
    "UA_BROWSER",
    "UA_BROWSERRENDERINGENGINE",
    "UA_BROWSERVERSION",
    "UA_DEVICETYPE",
    "UA_HARDWARETYPE",
    "UA_MOBILEDEVICE",
    "UA_MODEL",
    "UA_OS",
    "UA_OSVERSION",
    "UA_PLATFORM",
    "UA_PLATFORMVERSION",
    "UA_VENDOR",
]

DOUBLE_COLUMNS = ["ADLOADINGTIME", "GEOIP_LAT", "GEOIP_LNG"]
LONG_COLUMNS = [
    "TIMESTAMP",
    "HOSTWINDOWHEIGHT",
    "HOSTWINDOWWIDTH",
    "TOPMOSTREACHABLEWINDOWHEIGHT",
    "TOPMOSTREACHABLEWINDOWWIDTH",
    "UA_MOBILEDEVICE",
]

FEATURES_LR = [
    "COMBINEDID",
    "UA_BROWSERVERSION",
    "UA_OSCOMB",
    "UA_VENDOR",
    "PLATFORMCOMBINED",
    "COMBINEDEXTERNALID",
    "FILESJSON",
    "ACTUALDEVICETYPE",
    "ERRORSJSON",
    "UA_BROWSER",
    "TIMESTAMP",
    "CREATIVETYPE",
]

FEATURES_RF = [
    "COMBINEDID",
    "COMBINEDEXTERNALID",
    "CREATIVETYPE",
    "PLACEMENTID",
    "TIMESTAMP",
    "SDK",
    "EXTERNALADSERVER",
    "PLATFORMCOMBINED",
    "UA_HARDWARETYPE",
    "UA_VENDOR",
    "UA_MODEL",
    "UA_BROWSER",
    "UA_BROWSERVERSION",
    "TOPMOSTREACHABLEWINDOWAREA",
    "FILESJSON",
    "ERRORSJSON",
    "FILESJSON_IMGSIZE",
    "FILESJSON_VIDSIZE",
]

FEATURES_RF_LITE = [
    "PLACEMENTID",
    "TIMESTAMP",
    "CREATIVETYPE",
    "UA_HARDWARETYPE",
    "UA_VENDOR",
    "UA_MODEL",
    "UA_BROWSER",
    "UA_BROWSERVERSION",
    "FILESJSON",
    "ERRORSJSON",
    "TOPMOSTREACHABLEWINDOWAREA",
    "FILESJSON_IMGSIZE",
    "FILESJSON_VIDSIZE",
    "COMBINEDID",
    "COMBINEDEXTERNALID",
    "PLATFORMCOMBINED",
    "UA_OSCOMB",
    "SDK",
    "EXTERNALADSERVER",
]

FEATURES_SPARK_CATEGORICAL = [
    "PLACEMENTID",
    "CREATIVETYPE",
    "UA_HARDWARETYPE",
    "UA_VENDOR",
    "UA_MODEL",
    "UA_BROWSER",
    "UA_BROWSERVERSION",
    "FILESJSON",
    "ERRORSJSON",
    "COMBINEDID",
    "COMBINEDEXTERNALID",
    "PLATFORMCOMBINED",
    "UA_OSCOMB",
    "SDK",
    "EXTERNALADSERVER",
]
FEATURES_SPARK_NUMERIC = ["TIMESTAMP", "FILESJSON_SIZE", "TOPMOSTREACHABLEWINDOWAREA"]
FEATURES_SPARK = FEATURES_SPARK_CATEGORICAL + FEATURES_SPARK_NUMERIC

# Base list of the second add-one scan of the exploration, without the column
# that is no longer available at that point.
FEATURES_LR_SECOND_BASE = [
    "COMBINEDID",
    "UA_BROWSERVERSION",
    "UA_OSCOMB",
    "COMBINEDEXTERNALID",
    "TIMESTAMP",
    "ERRORSJSON",
    "UA_BROWSER",
    "UA_HARDWARETYPE",
    "UA_VENDOR",
    "UA_BROWSERRENDERINGENGINE",
    "CREATIVETYPE",
]

SEGMENT_KEYS = ["COMBINEDID", "PLACEMENTID", "FILESJSON"]
SEGMENT_KEYS_WIDE = [
    "COMBINEDID",
    "PLACEMENTID",
    "PLATFORMCOMBINED",
    "FILESJSON",
    "UA_VENDOR",
    "UA_MODEL",
    "UA_BROWSER",
    "UA_BROWSERVERSION",
]

TRIM_EXPLORE = 95.0
TRIM_TRAIN = 95.25
TRIM_VALIDATION = 94.40
TRIM_FILE_SIZE = 99.0
NO_TRIM = 100.0

AREA_MIN = 0
AREA_BELOW = 10_000_000
TIME_AFTER = 1458500000
TIME_BEFORE = 1461000000

SLOW_MEDIAN = 8.0
TARGET_CAP = 18.7
REBALANCE_TARGET = 10000
REBALANCE_WHOLE_BINS = 16
BIN_WIDTH = 0.5
SCORE_SHIFT = 0.3
BASELINE_CONSTANT = 3.90365759806
COUNTRY_WITH_REGIONS = "United States"
BLANK_KEY = "NA"

# Columns that the exploration gives up before modelling.
EXPLORE_DROPPED = [
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

FOREST_SPARK = {"trees": 50, "depth": 25, "bins": 1024, "rows": 1.0, "columns": "auto"}
FOREST_TRAIN = {"trees": 25, "depth": 50, "bins": 1024, "rows": 0.9, "columns": "0.6"}
FOREST_EXPLORE = {"trees": 20, "depth": 50, "bins": 1024, "rows": 0.5, "columns": "auto"}
FOREST_SLOW = {"trees": 20, "depth": 100, "bins": 1024, "rows": 0.5, "columns": "auto"}
