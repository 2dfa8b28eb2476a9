"""Explicit schemas; nothing is inferred between stages."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in (
    "holiday", "temp", "rain_1h", "snow_1h", "clouds_all", "weather_main",
    "weather_description", "date_time", "traffic_volume")])

RAW_TYPED = T.StructType([
    T.StructField("holiday", T.StringType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("rain_1h", T.DoubleType()),
    T.StructField("snow_1h", T.DoubleType()),
    T.StructField("clouds_all", T.IntegerType()),
    T.StructField("weather_main", T.StringType()),
    T.StructField("weather_description", T.StringType()),
    T.StructField("date_time", T.StringType()),
    T.StructField("traffic_volume", T.IntegerType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

CONDITIONS = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("weather", T.StringType()),
    T.StructField("temp_celsius", T.DoubleType()),
    T.StructField("clouds_all", T.IntegerType()),
    T.StructField("rain_1h", T.DoubleType()),
    T.StructField("snow_1h", T.DoubleType()),
    T.StructField("is_holiday", T.BooleanType()),
])
