"""Hour-of-day profiles and travel-time recommendations.

The data is reduced once to (day type, category, hour) sums; everything after
that works on at most 24 rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.operators.aggregates import hourly_profile
from hourlens.operators.relational import by_day_type, check_window, hour_window


def top_hours(df: DataFrame, day_type: str = "all", top: int = 3, measure: str = "measure",
              ts: str = "ts") -> DataFrame:
    """Busiest and quietest hours with the peak-to-trough ratio; ties to the lower hour."""
    prof = hourly_profile(by_day_type(df, day_type, ts), measure, ts)
    ends = fc.scalar(prof.agg(F.max("mean").alias("hi"), F.min("mean").alias("lo")))

    def side(kind: str, order: Column) -> DataFrame:
        short = prof.orderBy(order, "hour").limit(top)
        return short.select(F.lit(kind).alias("kind"),
                            F.row_number().over(Window.orderBy(order, "hour")).alias("rank"),
                            "hour", "mean", "n")

    return (side("busiest", F.desc("mean")).unionByName(side("quietest", F.asc("mean")))
            .withColumn("peak_to_trough", fc.ratio(ends["hi"], ends["lo"])))


def extreme_hours(df: DataFrame, measure: str = "measure", ts: str = "ts") -> DataFrame:
    """Per day type, the hour of the highest and of the lowest mean."""
    prof = hourly_profile(df, measure, ts, [fc.weekend_flag(ts).alias("is_weekend")])
    peak = F.min_by(F.struct("hour", "mean"), F.struct((-F.col("mean")).alias("m"), "hour"))
    low = F.min_by(F.struct("hour", "mean"), F.struct(F.col("mean").alias("m"), "hour"))
    return prof.groupBy("is_weekend").agg(peak.alias("_p"), low.alias("_l")).select(
        "is_weekend", F.col("_p.hour").alias("peak_hour"), F.col("_p.mean").alias("peak_mean"),
        F.col("_l.hour").alias("trough_hour"), F.col("_l.mean").alias("trough_mean"))


def advise(df: DataFrame, day_type: str = "weekday", earliest: int = 6, latest: int = 20,
           top: int = 3, measure: str = "measure", ts: str = "ts") -> DataFrame:
    """Quietest hours of a window against the row-weighted day-type mean.

    Negative ``relative_pct`` is quieter than average.  Every row also names
    the busiest hour of the window.
    """
    base = by_day_type(df, day_type, ts)
    prof = hourly_profile(hour_window(base, earliest, latest, ts), measure, ts)
    overall = fc.scalar(base.agg(F.avg(measure).alias("m")))["m"]
    worst = fc.scalar(prof.agg(F.max(F.struct("mean", "hour")).alias("w")))["w"]
    ranked = prof.orderBy("mean", "hour").limit(top)
    return (ranked.withColumn("rank", F.row_number().over(Window.orderBy("mean", "hour")))
            .select("rank", "hour", "mean",
                    fc.pct_change(F.col("mean"), overall).alias("relative_pct"),
                    worst["hour"].alias("busiest_hour"), worst["mean"].alias("busiest_mean")))


def _sums(df: DataFrame, measure: str, ts: str, category: str | None,
          keys: Sequence[str] = ()) -> DataFrame:
    extra = [F.col(category).alias("category")] if category else []
    return (df.groupBy(*keys, *extra, fc.weekend_flag(ts).alias("is_weekend"),
                       F.hour(ts).alias("hour"))
            .agg(F.sum(measure).alias("_sum"), F.count(measure).alias("_cnt"),
                 F.count("*").alias("_rows")))


def _per_day_type(sums: DataFrame) -> DataFrame:
    own = F.when(F.col("is_weekend") == 1, "weekend").otherwise("weekday")
    return sums.withColumn("day_type", F.explode(F.array(F.lit("all"), own)))


def profile(df: DataFrame, day_type: str = "weekday", category_value: str | None = None,
            min_n: int = config.FALLBACK_MIN_ROWS, measure: str = "measure", ts: str = "ts",
            category: str = "category") -> DataFrame:
    """Mean by hour under the conditions; a thin category falls back to all.

    The choice is made inside the plan, from one scan.
    """
    base = by_day_type(df, day_type, ts)
    if category_value is None:
        return hourly_profile(base, measure, ts).withColumn("is_fallback", F.lit(False))
    match = F.coalesce(F.col(category) == category_value, F.lit(False))
    both = base.groupBy(F.hour(ts).alias("hour")).agg(
        F.avg(measure).alias("_all"), F.count(measure).alias("_all_n"),
        F.avg(F.when(match, F.col(measure))).alias("_cat"),
        F.count(F.when(match, F.col(measure))).alias("_cat_n"),
        F.count_if(match).alias("_rows"))
    thin = fc.scalar(both.agg((F.sum("_rows") < min_n).alias("t")))["t"]
    return (both.select("hour", F.when(thin, F.col("_all")).otherwise(F.col("_cat")).alias("mean"),
                        F.when(thin, F.col("_all_n")).otherwise(F.col("_cat_n")).alias("n"),
                        thin.alias("is_fallback"))
            .where(F.col("n") > 0))


def _longest(hours: Column) -> Column:
    """Longest run of +1 steps in a short sorted array, the first one on a tie."""
    start = hours[0]
    zero = F.struct(start.alias("s"), start.alias("e"), start.alias("bs"), start.alias("be"))

    def step(acc: Column, h: Column) -> Column:
        s = F.when(h == acc["e"] + 1, acc["s"]).otherwise(h)
        longer = (h - s) > (acc["be"] - acc["bs"])
        return F.struct(s.alias("s"), h.alias("e"),
                        F.when(longer, s).otherwise(acc["bs"]).alias("bs"),
                        F.when(longer, h).otherwise(acc["be"]).alias("be"))

    return F.aggregate(hours, zero, step)


def from_profile(prof: DataFrame, keys: Sequence[str], earliest: int = 6, latest: int = 20,
                 top: int = 3) -> DataFrame:
    """One recommendation per key from a profile of at most 24 hours per key.

    ``percent_below_average`` compares with the unweighted mean of all hourly
    means, and is positive for a quieter hour.
    """
    check_window(earliest, latest)
    inside = F.when(F.col("hour").between(earliest, latest),
                    F.struct(F.col("mean"), F.col("hour")))
    g = (prof.groupBy(*keys)
         .agg(F.avg("mean").alias("_overall"), F.array_sort(F.collect_list(inside)).alias("_w"))
         .where(F.size("_w") > 0)
         .withColumn("_best", F.slice("_w", 1, top))
         .withColumn("_run", _longest(F.array_sort(F.transform("_best", lambda b: b["hour"]))))
         .withColumn("_worst", F.element_at("_w", -1)))
    best = F.col("_best")[0]["mean"]
    saving = fc.ratio(F.lit(100.0) * (F.col("_overall") - best), F.col("_overall"))
    run_start, run_end = F.col("_run")["bs"], F.col("_run")["be"]
    window_text = F.when(run_end > run_start, F.format_string(
        "between %02d:00 and %02d:00", run_start, run_end + 1)).otherwise(
        F.format_string("around %02d:00", run_start))
    return g.select(
        *keys, F.array(F.lit(earliest), F.lit(latest)).alias("search_window"),
        F.transform("_best", lambda b: F.struct(
            b["hour"].alias("hour"), F.round(b["mean"], 1).alias("mean_volume")))
        .alias("recommended_hours"),
        F.struct(F.col("_worst")["hour"].alias("hour"),
                 F.round(F.col("_worst")["mean"], 1).alias("mean_volume")).alias("busiest_hour"),
        F.round(saving, 1).alias("percent_below_average"),
        run_start.alias("run_start"), run_end.alias("run_end"),
        window_text.alias("_window"), best.alias("_mean"), saving.alias("_saving"),
        F.col("_worst")["mean"].alias("_worst_mean"))


def with_sentence(rec: DataFrame, day_type: Column, category: Column) -> DataFrame:
    # fixed values: wording of a recommendation
    wording = ("For %s journey%s, consider travelling %s, when historical traffic volumes "
               "average %s vehicles/hour — about %s%% below the daily average. Avoid %s, the "
               "busiest hour in this window at %s vehicles/hour.")
    day_text = (F.when(day_type == "weekday", "a weekday").when(day_type == "weekend", "a weekend")
                 .otherwise("any"))
    category_text = F.when(category.isNull(), "").otherwise(
        F.concat(F.lit(" in "), F.lower(category), F.lit(" conditions")))
    text = F.format_string(
        wording, day_text, category_text, F.col("_window"), fc.thousands("_mean"),
        fc.thousands("_saving"), fc.hour_label(F.col("busiest_hour")["hour"]),
        fc.thousands("_worst_mean"))
    return rec.withColumn("recommendation", text).drop("_window", "_mean", "_saving",
                                                       "_worst_mean")


def recommend(df: DataFrame, day_type: str = "weekday", category_value: str | None = None,
              earliest: int = 6, latest: int = 20, top: int = 3, measure: str = "measure",
              ts: str = "ts", category: str = "category",
              min_n: int = config.FALLBACK_MIN_ROWS) -> DataFrame:
    """One recommendation row; no row when the window holds no data."""
    check_window(earliest, latest)
    prof = profile(df, day_type, category_value, min_n, measure, ts, category)
    rec = from_profile(prof, [], earliest, latest, top)
    return with_sentence(rec.select(F.lit(day_type).alias("day_type"),
                                    F.lit(category_value).cast("string").alias("category"), "*"),
                         F.col("day_type"), F.col("category"))


def recommend_all(df: DataFrame, earliest: int = 6, latest: int = 20, top: int = 3,
                  measure: str = "measure", ts: str = "ts", category: str = "category",
                  min_n: int = config.FALLBACK_MIN_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """The same answer for every (key, day type, category) at once."""
    sums = _per_day_type(_sums(df, measure, ts, category, keys))
    group = [*keys, "day_type"]
    own = sums.groupBy(*group, "category", "hour").agg(
        F.sum("_sum").alias("_s"), F.sum("_cnt").alias("_c"), F.sum("_rows").alias("_r"))
    every = sums.groupBy(*group, "hour").agg(
        (F.sum("_sum") / F.sum("_cnt")).alias("mean"), F.sum("_cnt").alias("n"))
    size = own.groupBy(*group, "category").agg((F.sum("_r") < min_n).alias("is_fallback"))
    # a null category is a category: the join must not lose it
    full = size.where(~F.col("is_fallback")).select(
        *[F.col(c).alias(f"_g_{c}") for c in [*group, "category"]], "is_fallback")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}"))
                                       for c in [*group, "category"]])
    filled = (own.join(full, same)
              .select(*group, "category", "is_fallback", "hour",
                      (F.col("_s") / F.col("_c")).alias("mean")))
    thin = (size.where("is_fallback").join(every, group)
            .select(*group, "category", "is_fallback", "hour", "mean"))
    rec = from_profile(filled.unionByName(thin), [*group, "category", "is_fallback"],
                       earliest, latest, top)
    return with_sentence(rec, F.col("day_type"), F.col("category"))
