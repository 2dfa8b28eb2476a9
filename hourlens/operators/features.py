"""Feature construction.  The same functions serve training and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions.quantiles import quantiles


def add_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Calendar parts and their positions on the daily and weekly circle."""
    df = df.withColumns({
        "hour": F.hour(ts), "day_of_week": fc.day_of_week(ts), "month": F.month(ts),
        "year": F.year(ts), "is_weekend": fc.weekend_flag(ts)})
    hour_sin, hour_cos = fc.cyclic("hour", 24)
    dow_sin, dow_cos = fc.cyclic("day_of_week", 7)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos,
                           "dow_sin": dow_sin, "dow_cos": dow_cos})


NAMES = 4096            # rare categories that the driver takes


def rare_categories(df: DataFrame, column: str, min_n: int = config.RARE_CATEGORY_MIN) -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias("n")).where(F.col("n") < min_n))


def rare_to_other(df: DataFrame, column: str, min_n: int = config.RARE_CATEGORY_MIN,
                  out: str = "category_grouped", other: str = "Other") -> DataFrame:
    """Fold categories with fewer than ``min_n`` rows into one.

    The rare names are counted now, and up to ``NAMES`` of them are tested row by row.  Joined, they would send all
    rows of a category to one task: AQE splits those only where the rare side has rows.  More names than that are
    joined; AQE broadcasts them when their measured size allows, and splits the rows of a common category otherwise.
    """
    rare = rare_categories(df, column, min_n).select(F.col(column).alias("_rare"))
    names = [r["_rare"] for r in rare.limit(NAMES + 1).collect()]
    if len(names) <= NAMES:
        return df.withColumn(out, F.when(F.col(column).isin(names), F.lit(other)).otherwise(F.col(column)))
    return (df.join(rare, df[column] == rare["_rare"], "left")
            .withColumn(out, F.when(F.col("_rare").isNotNull(), F.lit(other))
                        .otherwise(F.col(column)))
            .drop("_rare"))


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str) -> DataFrame:
    """0/1 columns for a pinned list of levels, so the width never varies."""
    return df.withColumns({
        f"{prefix}_{level}": F.coalesce(F.col(column) == level, F.lit(False)).cast("int")
        for level in levels})


def unseen_levels(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Rows per category that the pinned list does not cover."""
    return (df.where(~F.coalesce(F.col(column).isin(list(levels)), F.lit(False)))
            .groupBy(column).agg(F.count("*").alias("n")))


def add_flags(df: DataFrame, category: str = "category", rain: str = "rain_1h",
              snow: str = "snow_1h", temp: str = "temp",
              severe: Sequence[str] = config.SEVERE_WEATHER,
              low_visibility: Sequence[str] = config.LOW_VISIBILITY_WEATHER) -> DataFrame:
    return df.withColumns({
        "is_precipitation": fc.member_flag(category, severe),
        "is_low_visibility": fc.member_flag(category, low_visibility),
        "has_rain": fc.positive_flag(rain), "has_snow": fc.positive_flag(snow),
        "temp_celsius": F.col(temp) - config.KELVIN_OFFSET})


def scaling_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: population mean and deviation, minimum and maximum per column."""
    return df.agg(*[agg(c).alias(f"{c}_{name}") for c in columns
                    for name, agg in (("mean", F.avg), ("std", F.stddev_pop),
                                      ("min", F.min), ("max", F.max))])


def scaling_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same statistics as a table, one row per column, for inversion."""
    stats = scaling_stats(df, columns)
    return stats.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 *[F.col(f"{c}_{name}").cast("double").alias(name)
                   for name in ("mean", "std", "min", "max")]) for c in columns])))


def zscore(df: DataFrame, columns: Sequence[str],
           stats: Mapping[str, Column] | None = None) -> DataFrame:
    s = stats if stats is not None else fc.fitted(scaling_stats(df, columns))
    return df.withColumns({f"{c}_z": fc.ratio(F.col(c) - s[f"{c}_mean"], s[f"{c}_std"])
                           for c in columns})


def minmax(df: DataFrame, columns: Sequence[str],
           stats: Mapping[str, Column] | None = None) -> DataFrame:
    s = stats if stats is not None else fc.fitted(scaling_stats(df, columns))
    return df.withColumns({
        f"{c}_minmax": fc.ratio(F.col(c) - s[f"{c}_min"], s[f"{c}_max"] - s[f"{c}_min"])
        for c in columns})


def train_only_scale(df: DataFrame, columns: Sequence[str], is_train: str = "is_train",
                     eps: float = 1e-8) -> DataFrame:
    """Standardise all rows with the statistics of the training rows."""
    s = fc.fitted(scaling_stats(df.where(F.col(is_train)), columns))
    return df.withColumns({f"{c}_z": (F.col(c) - s[f"{c}_mean"]) / (s[f"{c}_std"] + F.lit(eps))
                           for c in columns})


def quartile_target(df: DataFrame, measure: str = "measure",
                    threshold: float = config.CONGESTION_THRESHOLD,
                    labels: Sequence[str] = config.CONGESTION_LEVELS) -> DataFrame:
    """Label by quartile (upper edge inclusive), its code, and a fixed-threshold flag.

    A null measure has no level and code -1.
    """
    q = fc.fitted(quantiles(df, measure, [0.25, 0.5, 0.75]).select("q"))["q"]
    m = F.col(measure)
    level = (F.when(m <= q[0], labels[0]).when(m <= q[1], labels[1])
              .when(m <= q[2], labels[2]).when(m > q[2], labels[3]))
    df = df.withColumn("congestion_level", level)
    return df.withColumns({
        "congestion_code": fc.ordinal("congestion_level",
                                      {v: i for i, v in enumerate(labels)}, -1),
        "is_congested": F.coalesce(m > threshold, F.lit(False)).cast("int")})


def proxy_label(df: DataFrame, category: str = "category", level: str = "congestion_level",
                severe: Sequence[str] = config.SEVERE_WEATHER, low_vis: str = "is_low_visibility",
                levels: Sequence[str] = config.HIGH_LEVELS) -> DataFrame:
    """1 when the hour is busy and its weather severe or of low visibility."""
    risky = (fc.member_flag(category, severe) == 1) | (F.col(low_vis) == 1)
    busy = fc.member_flag(level, levels) == 1
    return df.withColumn("high_risk", (busy & risky).cast("int"))


def label_balance(df: DataFrame, label: str = "high_risk",
                  warn_below: float = config.IMBALANCE_RATE) -> DataFrame:
    return df.agg(F.sum(label).alias("n_positive"),
                  (F.count("*") - F.sum(label)).alias("n_negative"),
                  F.avg(label).alias("rate")).withColumn("is_imbalanced",
                                                         F.col("rate") < warn_below)


def build(df: DataFrame, *, ts: str = "ts", category: str = "category", measure: str = "measure",
          levels: Sequence[str] = config.WEATHER_LEVELS, prefix: str = "weather",
          min_n: int = config.RARE_CATEGORY_MIN, scaled: Sequence[str] = ("temp", "clouds_all"),
          severe: Sequence[str] = config.SEVERE_WEATHER,
          low_visibility: Sequence[str] = config.LOW_VISIBILITY_WEATHER,
          threshold: float = config.CONGESTION_THRESHOLD) -> DataFrame:
    """Time, category, flag, scaled and target features in one lazy chain."""
    df = add_time(df, ts)
    df = one_hot(rare_to_other(df, category, min_n), "category_grouped", levels, prefix)
    df = add_flags(df, category, severe=severe, low_visibility=low_visibility)
    stats = fc.fitted(scaling_stats(df, scaled))
    df = minmax(zscore(df, scaled, stats), scaled, stats)
    return quartile_target(df, measure, threshold)


def from_conditions(df: DataFrame, *, ts: str = "timestamp", category: str = "weather",
                    levels: Sequence[str] = config.WEATHER_LEVELS, prefix: str = "weather",
                    severe: Sequence[str] = config.SEVERE_WEATHER,
                    low_visibility: Sequence[str] = config.LOW_VISIBILITY_WEATHER,
                    features: Sequence[str] = config.FEATURE_COLUMNS,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Model inputs for stated conditions, in training order, all doubles."""
    df = add_time(df, ts).withColumn("temp", F.col("temp_celsius") + config.KELVIN_OFFSET)
    df = df.withColumn("is_holiday", F.col("is_holiday").cast("int"))
    df = add_flags(df, category, severe=severe, low_visibility=low_visibility)
    df = one_hot(df, category, levels, prefix)
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])


# --- splits -----------------------------------------------------------------
def split_hash(df: DataFrame, key: str, test: float = 0.2) -> DataFrame:
    """Add ``is_test`` from the key's hash: repeatable, no shuffle."""
    limit = format(int(test * 0x100000000), "08x")
    return df.withColumn("is_test", F.substring(F.md5(F.col(key).cast("string")), 1, 8) < limit)


def split_stratified(df: DataFrame, key: str, label: str, test: float = 0.2) -> DataFrame:
    """Add ``is_test`` so that each class gives exactly ``round(test * n)`` rows.

    The hash prefix cuts every class into 65,536 slices.  Whole slices below
    the class's cut go to test; only the slice the cut falls into is ranked,
    so a class holding most rows never meets in one task.
    """
    h = F.md5(F.col(key).cast("string"))
    tagged = df.withColumn("_h", h).withColumn("_s", F.substring("_h", 1, 4))
    slices = tagged.groupBy(F.col(label).alias("_label"), "_s").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("_label").orderBy("_s")
    total = F.sum("_n").over(Window.partitionBy("_label"))
    quota = F.round(F.lit(test) * total).cast("bigint")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = slices.select("_label", F.col("_s").alias("_cut"), quota.alias("_q"),
                         before.alias("_before"), "_n")
    # one row per class: the slice where the quota is reached
    cut = (plan.where((F.col("_before") < F.col("_q"))
                      & (F.col("_before") + F.col("_n") >= F.col("_q")))
           .select("_label", "_cut", (F.col("_q") - F.col("_before")).alias("_take")))
    # broadcast, as joining on the label would send each class to one task
    joined = tagged.join(F.broadcast(cut), tagged[label].eqNullSafe(cut["_label"]), "left")
    at_cut = F.coalesce(F.col("_s") == F.col("_cut"), F.lit(False))
    clear = joined.where(~at_cut).withColumn(
        "is_test", F.coalesce(F.col("_s") < F.col("_cut"), F.lit(False)))
    # only the cut slices (a 65,536th of each class) are shuffled and ranked
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_h", key))
    edge = joined.where(at_cut).withColumn("is_test", rank <= F.col("_take"))
    return clear.unionByName(edge).select(*df.columns, "is_test")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight ``n / (classes * n_class)`` per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = fc.scalar(counts.agg(F.sum("n").alias("n"), F.count("*").alias("k")))
    return counts.withColumn("weight", total["n"] / (total["k"] * F.col("n")))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the balanced weight of a 0/1 label."""
    s = fc.fitted(df.agg(F.count("*").alias("n"), F.sum(label).alias("pos")))
    pos, neg = s["pos"], s["n"] - s["pos"]
    classes = (pos > 0).cast("int") + (neg > 0).cast("int")
    own = F.when(F.col(label) == 1, pos).otherwise(neg)
    return df.withColumn(out, s["n"] / (classes * own))
