"""Declared schemas of every layer; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

OBS_COLUMNS = ["district", "year_mon_day", "week", "max_t", "min_t",
               "weather", "wind", "aqi", "aqi_type"]

# Raw landed pages: one row per fetched (area, year, month) target.
PAGES = T.StructType([
    T.StructField("url", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
])

# ODS: staged text, every column a string.
ODS = T.StructType([T.StructField(c, T.StringType(), True) for c in OBS_COLUMNS])

# DWD: typed, cleaned observations.  Key: (district, year_mon_day).
DWD = T.StructType([
    T.StructField("district", T.StringType(), True),
    T.StructField("year_mon_day", T.StringType(), True),
    T.StructField("week", T.StringType(), True),
    T.StructField("max_t", T.IntegerType(), True),
    T.StructField("min_t", T.IntegerType(), True),
    T.StructField("weather", T.StringType(), True),
    T.StructField("wind", T.StringType(), True),
    T.StructField("aqi", T.DoubleType(), True),
    T.StructField("aqi_type", T.StringType(), True),
])

DWD_COLUMNS = [f.name for f in DWD.fields]

#: Natural key of the observations.
ODS_KEY = ["district", "year_mon_day"]
