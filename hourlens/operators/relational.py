"""Filters, look-ups and joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc


# --- filters ----------------------------------------------------------------
def in_years(df: DataFrame, ts: str, first: int, last: int) -> DataFrame:
    """Rows of whole calendar years, as a timestamp range Parquet can prune on."""
    return df.where((F.col(ts) >= F.lit(datetime(first, 1, 1)).cast("timestamp_ntz"))
                    & (F.col(ts) < F.lit(datetime(last + 1, 1, 1)).cast("timestamp_ntz")))


def by_day_type(df: DataFrame, day_type: str = "all", ts: str = "ts") -> DataFrame:
    if day_type not in ("all", "weekday", "weekend"):
        raise ValueError(f"day_type must be all, weekday or weekend, not {day_type!r}")
    if day_type == "all":
        return df
    return df.where(fc.weekend_flag(ts) == (1 if day_type == "weekend" else 0))


def check_window(earliest: int, latest: int) -> None:
    """Reject an hour window before any plan is built."""
    if not (0 <= earliest <= 23 and 0 <= latest <= 23):
        raise ValueError("hours must be between 0 and 23")
    if earliest > latest:
        raise ValueError(f"earliest hour {earliest} is after latest hour {latest}")


def hour_window(df: DataFrame, earliest: int = 6, latest: int = 20, ts: str = "ts") -> DataFrame:
    check_window(earliest, latest)
    return df.where(F.hour(ts).between(earliest, latest))


def split_at(df: DataFrame, cutoff: datetime, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff, rows from the cutoff on."""
    limit = F.lit(cutoff).cast("timestamp_ntz")
    return df.where(F.col(ts) < limit), df.where(F.col(ts) >= limit)


def check_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = config.REQUEST_BOUNDS,
                 members: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Add ``reasons`` (failed columns, sorted) and ``is_valid``; nulls fail."""
    failed = []
    for name, (low, high) in bounds.items():
        ok = F.coalesce(F.col(name).between(low, high), F.lit(False))
        failed.append(F.when(~ok, F.lit(name)))
    for name, allowed in (members or {}).items():
        ok = F.coalesce(F.col(name).isin(list(allowed)), F.lit(False))
        failed.append(F.when(~ok, F.lit(name)))
    reasons = F.array_sort(F.array_compact(F.array(*failed)))
    return df.withColumn("reasons", reasons).withColumn("is_valid", F.size("reasons") == 0)


# --- joins ------------------------------------------------------------------
def tag_dates(df: DataFrame, tag: str = "tag", ts: str = "ts") -> DataFrame:
    """One row per (tag, date, year) on which the sparse tag occurs."""
    return (df.where(F.col(tag).isNotNull())
            .select(tag, F.to_date(ts).alias("tag_date"), F.year(ts).alias("year"))
            .distinct())


def join_dim_back(df: DataFrame, dim: DataFrame, on_date: str = "tag_date",
                  ts: str = "ts") -> DataFrame:
    """All rows that fall on a date of the dimension.

    The dimension has one row per tag and day, and the number of tags is data: a plain join,
    which AQE turns into a broadcast where the measured size allows it.
    """
    return df.join(dim, F.to_date(df[ts]) == dim[on_date], "inner")


def propagate_tag(df: DataFrame, tag: str = "tag", ts: str = "ts",
                  dim: DataFrame | None = None) -> DataFrame:
    """Give every row of a tagged date its tag, plus ``is_<tag>`` 0/1.

    Several tags on one date: the greatest one wins, so the result does not
    depend on row order.  At most one row per calendar day is broadcast.
    """
    if dim is None:
        dim = (df.where(F.col(tag).isNotNull())
               .groupBy(F.to_date(ts).alias("_date")).agg(F.max(tag).alias("_tag")))
    else:
        dim = dim.groupBy(F.col("tag_date").alias("_date")).agg(F.max(tag).alias("_tag"))
    keep = [c for c in df.columns if c != tag]
    return (df.select(*keep, F.to_date(ts).alias("_date"))
            .join(F.broadcast(dim), "_date", "left")
            .select(*keep, F.col("_tag").alias(tag),
                    F.col("_tag").isNotNull().cast("int").alias(f"is_{tag}")))


def join_tagged_dates(stage: DataFrame, dim: DataFrame, day: str) -> DataFrame:
    """Rows of a date-partitioned stage on tagged dates, with the tag.

    ``dim`` (``tag_date, tag``) joins on the partition column itself, so the dates it holds reach the scan as a
    pruning filter at run time and other dates' files are not opened.  At most one row per calendar day is
    broadcast."""
    # a comparison, not only IS NOT NULL: the optimizer prunes by dimensions it takes for selective
    one = dim.where(F.col("tag") >= "").groupBy(F.col("tag_date").alias(day)).agg(F.max("tag").alias("tag"))
    return stage.join(F.broadcast(one), day)


def unknown_members(df: DataFrame, column: str, requested: Sequence[str]) -> DataFrame:
    """Requested values that never occur in the column."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in requested], f"{column} string")
    seen = df.where(F.col(column).isin(list(requested))).select(column).distinct()
    return wanted.join(seen, column, "left_anti")


# --- nearest observation ----------------------------------------------------
def nearest_to(df: DataFrame, target: datetime, ts: str = "ts") -> DataFrame:
    """The row at the hour of ``target``, else the closest; ties go to the earlier."""
    hour = target.replace(minute=0, second=0, microsecond=0)
    gap = F.abs(fc.epoch_micros(ts) - fc.epoch_micros(F.lit(hour).cast("timestamp_ntz")))
    return (df.withColumn("gap_seconds", F.floor(gap / 1_000_000))
            .orderBy("gap_seconds", ts).limit(1)
            .withColumn("is_exact", F.col("gap_seconds") == 0))


def nearest(df: DataFrame, probes: DataFrame, ts: str = "ts", probe_ts: str = "probe_ts",
            block_hours: int = 24 * 7) -> DataFrame:
    """For every probe hour, the closest observed hour (ties to the earlier).

    Time is cut into blocks.  Inside a block the neighbours come from a window;
    across blocks they come from a table with the first and last hour of each
    block, so no window ever spans the whole time axis.  Both sides are first
    reduced to distinct hours, so a hot hour is a single row.
    """
    seen = df.select(fc.epoch_hours(ts).alias("_h")).distinct()
    asked = probes.select(fc.epoch_hours(probe_ts).alias("_h")).distinct()
    axis = (seen.select("_h", F.col("_h").alias("_s"), F.lit(0).alias("_p"))
            .unionByName(asked.select("_h", F.lit(None).cast("bigint").alias("_s"),
                                      F.lit(1).alias("_p")))
            .groupBy("_h").agg(F.max("_s").alias("_s"), F.max("_p").alias("_p"))
            .withColumn("_blk", F.floor(F.col("_h") / block_hours)))

    # one row per block of the calendar: a small, bounded table
    order = Window.orderBy("_blk")
    edges = (axis.groupBy("_blk").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
             .select("_blk",
                     F.last("_last", ignorenulls=True).over(
                         order.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"),
                     F.first("_first", ignorenulls=True).over(
                         order.rowsBetween(1, Window.unboundedFollowing)).alias("_next")))
    inner = Window.partitionBy("_blk").orderBy("_h")
    local = axis.select(
        "_h", "_p", "_blk",
        F.last("_s", ignorenulls=True).over(
            inner.rowsBetween(Window.unboundedPreceding, 0)).alias("_before"),
        F.first("_s", ignorenulls=True).over(
            inner.rowsBetween(0, Window.unboundedFollowing)).alias("_after"))
    before = F.coalesce("_before", "_prev")
    after = F.coalesce("_after", "_next")
    pick = (F.when(before.isNull(), after).when(after.isNull(), before)
             .when(F.col("_h") - before <= after - F.col("_h"), before).otherwise(after))
    found = (local.where("_p = 1").join(F.broadcast(edges), "_blk")
             .select("_h", pick.alias("_hit")))

    def as_ts(h: str) -> Column:
        return F.timestamp_seconds(F.col(h) * 3600).cast("timestamp_ntz")

    return found.select(as_ts("_h").alias("probe_hour"), as_ts("_hit").alias("nearest_hour"),
                        F.abs(F.col("_h") - F.col("_hit")).alias("gap_hours"),
                        (F.col("_h") == F.col("_hit")).alias("is_exact"))


# --- sampling ---------------------------------------------------------------
def hash_order(key: Column | str, seed: int = 42) -> Column:
    """A reproducible pseudo-random order that any engine with md5 can repeat."""
    return F.md5(F.concat(fc.col(key).cast("string"), F.lit(f":{seed}")))


def sample_hash(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run (top-n by hash)."""
    return df.orderBy(hash_order(key, seed), key).limit(n)
