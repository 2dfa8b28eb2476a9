"""Inputs several plans share: predictions, scores and the cleaning set-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.operators.cleaning import CleanConfig
from hourlens.sources import views

CLEAN = CleanConfig(
    timestamp_text="date_time", ts="ts", category="category", text=("category", "tag"),
    fill_text=("category",), numeric=("value", "k"), tag="tag", tag_sentinel="None",
    bounds={"value": (None, 1000.0)}, severity=views.SEVERITY, zero_kept=("value", "k"),
    tiebreak=("event_id",))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """A given linear guess beside the observed value."""
    guess = F.lit(49.0) + (F.col("k") - 50) / 5.0 + fc.day_of_week("ts") + 1
    return views.obs(spark, d).select("event_id", "hour_ts", "ts", "category",
                                      F.col("value").alias("y"),
                                      F.round(guess, 3).alias("prediction"))


def scores(spark: SparkSession, d: str) -> DataFrame:
    """A given risk score with many ties, and its thresholded label."""
    points = F.col("k") + 5 * F.col("category").isin("signup", "click").cast("int")
    return views.obs(spark, d).select(
        "event_id", "category", (F.col("value") > 60).cast("int").alias("y"),
        (points / 110.0).alias("score"), (points >= 52).cast("int").alias("prediction"))
