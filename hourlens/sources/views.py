"""The driver's tables seen as observation tables.

``orders`` is a multi-year series, ``events`` an hourly stream with several rows
per hour.  All views are lazy and read only the columns a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.operators.windows import keep_best

SEVERITY = {"error": 4, "purchase": 3, "signup": 2, "click": 1, "view": 0}
LEVELS = ["click", "error", "purchase", "signup", "view", "Other"]
SEVERE = ["error", "purchase"]
LOW_VISIBILITY = ["view"]
FAIR = ["view", "click"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations, several per hour."""
    return table(spark, sf_dir, "events").select(
        "event_id", fc.floor_hour("ts").alias("hour_ts"), "ts", "user_id",
        F.col("event_type").alias("category"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def obs_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with padded text, sentinels, nulls and exact repeats."""
    def slice_of(tag: str):
        return F.substring(F.md5(F.concat(F.lit(tag), F.col("event_id").cast("string"))), 1, 2)

    base = obs(spark, sf_dir).select(
        "event_id", "hour_ts", "ts", "user_id",
        F.when(slice_of("p") < "08", F.concat(F.lit("  "), "category", F.lit(" ")))
         .otherwise(F.col("category")).alias("category"),
        F.when(slice_of("x") < "04", F.lit(9999.0)).when(slice_of("n") < "04", None)
         .otherwise(F.col("value")).alias("value"), "k")
    # repeats come from one pass that emits a row once or twice
    return base.withColumn("_r", F.explode(F.when(slice_of("d") < "03", F.array(F.lit(0), F.lit(1)))
                                            .otherwise(F.array(F.lit(0))))).drop("_r")


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty rows as text-stamped raw input with a sparse tag."""
    d = obs_dirty(spark, sf_dir)
    broken = F.substring(F.md5(F.concat(F.lit("t"), F.col("event_id").cast("string"))), 1, 2)
    stamp = F.date_format("hour_ts", "yyyy-MM-dd HH:mm:ss")
    tag = (F.when(stamp == "2024-01-01 00:00:00", "new_year")
            .when(stamp == "2024-01-15 00:00:00", "mid_month").otherwise("None"))
    return d.select(F.when(broken < "02", F.concat(F.lit("?"), stamp)).otherwise(stamp)
                     .alias("date_time"),
                    "event_id", "user_id", "category", "value", "k", tag.alias("tag"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour: the most severe event, smallest id on a tie."""
    base = obs(spark, sf_dir).select("hour_ts", "event_id", "category", "value", "k")
    sev = fc.ordinal("category", SEVERITY, -1)
    return keep_best(base.withColumn("sev", sev), "hour_ts", F.col("sev"), ["event_id"])


def no_gap() -> Column:
    """False for the hours that a gappy series lacks."""
    return ~((F.dayofmonth("hour_ts") == 11) | ((F.hour("hour_ts") == 3) & F.dayofmonth("hour_ts").isin(5, 17)))


def hourly_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(spark, sf_dir).where(no_gap())


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("volume"),
        F.col("o_orderpriority").alias("category"), "o_custkey")


def daily_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series with a tag on one row of each tagged date.

    The tag sits on the smallest key of the date, as sparse tags do.
    """
    d = daily(spark, sf_dir)
    tag = (F.when((F.month("ts") == 1) & (F.dayofmonth("ts") == 1), "new_year")
            .when((F.month("ts") == 9) & (F.dayofmonth("ts") == 4), "labor"))
    marked = (d.withColumn("_tag", tag).where("_tag is not null")
              .groupBy(F.to_date("ts").alias("_d")).agg(F.min("o_orderkey").alias("_k"),
                                                        F.max("_tag").alias("tag")))
    # one row per tagged calendar day
    on = (F.to_date(d["ts"]) == marked["_d"]) & (d["o_orderkey"] == marked["_k"])
    return d.join(F.broadcast(marked), on, "left").drop("_d", "_k")


def feature_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations under the generic column names of the feature operators."""
    o = obs(spark, sf_dir)
    return o.select(
        "event_id", "ts", "hour_ts", "category", F.col("value").alias("measure"), "k",
        (F.col("k") + F.lit(243.15)).alias("temp"),
        F.when(F.col("category") == "purchase", F.col("value") / 10).otherwise(0.0)
         .alias("rain_1h"),
        F.when((F.col("category") == "error") & (F.col("k") < 30), F.col("value") / 10)
         .otherwise(0.0).alias("snow_1h"),
        F.col("k").cast("double").alias("clouds_all"),
        F.to_date("ts").isin(*[F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-15")])
         .cast("int").alias("is_holiday"))


FEATURES = [
    "hour", "day_of_week", "month", "is_weekend", "is_holiday",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "temp", "rain_1h", "snow_1h", "clouds_all",
    "is_precipitation", "is_low_visibility", "has_rain", "has_snow",
    *[f"cat_{level}" for level in LEVELS],
]


def feat(spark: SparkSession, sf_dir: str, min_n: int = 1985) -> DataFrame:
    """The full feature table over the observations."""
    from hourlens.operators import features as fx

    return fx.proxy_label(
        fx.build(feature_input(spark, sf_dir), levels=LEVELS, prefix="cat", min_n=min_n,
                 severe=SEVERE, low_visibility=LOW_VISIBILITY, threshold=60.0),
        severe=SEVERE)
