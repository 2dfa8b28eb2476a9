"""Group aggregates and profiles.

All of them are partial + final hash aggregates on keys with few values, so a
key that holds a third of the rows is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions.quantiles import median


def yearly(df: DataFrame, measure: str = "measure", ts: str = "ts") -> DataFrame:
    """Per year: rows, total and mean (unrounded)."""
    return (df.groupBy(F.year(ts).alias("year"))
            .agg(F.count("*").alias("hours_recorded"),
                 F.sum(measure).alias("total"), F.avg(measure).alias("mean")))


def monthly_count(df: DataFrame, ts: str = "ts") -> DataFrame:
    return (df.groupBy(F.date_format(ts, "yyyy-MM").alias("month"))
            .agg(F.count("*").alias("hours_recorded")))


def hourly_profile(df: DataFrame, measure: str = "measure", ts: str = "ts",
                   keys: Sequence[Column | str] = ()) -> DataFrame:
    """Mean and rows by hour of day, optionally per extra key."""
    return (df.groupBy(*keys, F.hour(ts).alias("hour"))
            .agg(F.avg(measure).alias("mean"), F.count(measure).alias("n")))


def category_profile(df: DataFrame, category: str = "category", measure: str = "measure",
                     small_n: int = config.SMALL_SAMPLE) -> DataFrame:
    """Mean and rows per category, thin ones flagged."""
    return (df.groupBy(category)
            .agg(F.avg(measure).alias("mean"), F.count(measure).alias("n"))
            .withColumn("is_small", F.col("n") < small_n))


def category_range(profile: DataFrame) -> DataFrame:
    """Spread of category means over all categories and over well-filled ones."""
    good = F.when(~F.col("is_small"), F.col("mean"))
    return profile.agg(
        F.min("mean").alias("min_mean"), F.max("mean").alias("max_mean"),
        (F.max("mean") - F.min("mean")).alias("range_all"),
        F.min(good).alias("min_mean_reliable"), F.max(good).alias("max_mean_reliable"),
        (F.max(good) - F.min(good)).alias("range_reliable"))


def weekday_weekend(df: DataFrame, measure: str = "measure", ts: str = "ts") -> DataFrame:
    """One row: mean, exact median and rows of both day types, and their difference."""
    flagged = df.select(fc.weekend_flag(ts).alias("is_weekend"), F.col(measure).alias("_m"))
    base = flagged.groupBy("is_weekend").agg(F.avg("_m").alias("mean"), F.count("*").alias("n"))
    mids = median(flagged, "_m", ["is_weekend"], few_groups=True).select("is_weekend", "median")
    both = base.join(F.broadcast(mids), "is_weekend", "left")       # two rows each

    def pick(flag: int, name: str) -> Column:
        return F.max(F.when(F.col("is_weekend") == flag, F.col(name)))

    row = both.agg(*[pick(flag, name).alias(f"{label}_{name}")
                     for flag, label in ((0, "weekday"), (1, "weekend"))
                     for name in ("mean", "median", "n")])
    return (row.withColumn("difference", F.col("weekday_mean") - F.col("weekend_mean"))
               .withColumn("pct_vs_weekend", fc.pct_change("weekday_mean", "weekend_mean")))


def cluster_profile(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size and means per cluster."""
    return df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.avg("hour").alias("mean_hour"),
        F.avg("measure").alias("mean_measure"), F.avg("severity").alias("mean_severity"),
        F.avg("temp").alias("mean_temp"), F.avg("is_weekend").alias("weekend_share"))


def coverage(df: DataFrame, ts: str = "ts", low: int = config.LOW_COVERAGE_ROWS) -> DataFrame:
    """Rows per month, the median month, and a flag on thin months.

    Months without any row do not appear; see ``coverage_spine``.
    """
    months = df.groupBy(fc.floor_month(ts).alias("month")).agg(F.count("*").alias("n"))
    # one row per calendar month: percentile over it is bounded
    mid = fc.scalar(months.agg(F.percentile("n", 0.5).alias("m")))
    return months.select("month", "n", mid["m"].alias("median_n"),
                         (F.col("n") < low).alias("is_low"))


def coverage_spine(df: DataFrame, ts: str = "ts", unit: str = "month") -> DataFrame:
    """Every month (or hour) between first and last, with its row count, 0 included."""
    counts = df.groupBy(F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("period")) \
               .agg(F.count("*").alias("n"))
    ends = counts.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    spine = ends.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval 1 {unit}")))
                        .alias("period"))
    return (spine.join(counts, "period", "left")
            .select("period", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
            .withColumn("is_missing", F.col("n") == 0))


def histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Equal-width counts, last bin closed; empty bins give no row."""
    ends = fc.fitted(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
    width = (ends["hi"] - ends["lo"]).cast("double")
    spot = F.coalesce(F.try_divide(F.col(column) - ends["lo"], width), F.lit(0.0))
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.least(F.floor(spot * bins) + 1, F.lit(bins)).cast("int").alias("bin"))
            .agg(F.count("*").alias("n")))


def binned_mean(df: DataFrame, x: str, y: str, start: float = -30.0, step: float = 2.5,
                n: int = 27) -> DataFrame:
    """Mean of ``y`` per right-closed bin of ``x``; rows outside the bins drop out."""
    at = fc.right_closed_bin(x, start, step, n)
    return (df.select(at.alias("bin"), F.col(y).alias("_y")).where("bin is not null")
            .groupBy("bin").agg(F.avg("_y").alias("mean"), F.count("*").alias("n"))
            .withColumn("centre", F.col("bin") * step + (start + step / 2)))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its null count, from a single pass."""
    wide = df.agg(*[fc.count_rows(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "n_null")


def duplicate_profile(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Fully identical rows, and repeated timestamps among the distinct rows.

    Counted in two grouped steps, so copies of one row never meet in one task.
    """
    distinct = df.groupBy(*df.columns).agg(F.count("*").alias("_c"))
    per_ts = distinct.groupBy(ts).agg(F.sum("_c").alias("_rows"), F.count("*").alias("_kinds"))
    return per_ts.agg(F.sum("_rows").alias("n_rows"),
                      (F.sum("_rows") - F.sum("_kinds")).alias("exact_duplicates"),
                      (F.sum("_kinds") - F.count("*")).alias("repeated_timestamps"))


def kpi(df: DataFrame, measure: str, other: str, valid: Column) -> DataFrame:
    """One row: rows, mean measure, mean of ``other`` on all and on valid rows."""
    return df.agg(F.count("*").alias("n"), F.avg(measure).alias("mean_measure"),
                  F.avg(other).alias("mean_other"),
                  F.avg(F.when(valid, F.col(other))).alias("mean_other_valid"))


def contingency(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """2x2 table of two predicates, long form with zero cells kept."""
    a, b = F.coalesce(a, F.lit(False)), F.coalesce(b, F.lit(False))
    wide = df.agg(F.count_if(~a & ~b).alias("n00"), F.count_if(~a & b).alias("n01"),
                  F.count_if(a & ~b).alias("n10"), F.count_if(a & b).alias("n11"))
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(i == "1").alias("a"), F.lit(j == "1").alias("b"),
                 F.col(f"n{i}{j}").alias("n")) for i in "01" for j in "01"])))
