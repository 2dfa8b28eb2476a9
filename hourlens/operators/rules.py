"""Frequent itemsets and association rules over one item per attribute."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc


def attributes(df: DataFrame, *, hour: str = "hour", is_weekend: str = "is_weekend",
               category: str = "category", temp: str = "temp_celsius",
               level: str = "congestion_level",
               fair: Sequence[str] = config.FAIR_WEATHER) -> DataFrame:
    """The five discretised attributes of an hour; out-of-range bands are null."""
    return df.select(
        fc.cut_labels(hour, *config.TIME_BANDS).alias("time_band"),
        F.when(F.col(is_weekend) == 1, "weekend").otherwise("weekday").alias("day_type"),
        F.when(F.col(category).isin(list(fair)), "fair_weather")
         .otherwise("adverse_weather").alias("weather_band"),
        fc.cut_labels(temp, *config.TEMP_BANDS).alias("temp_band"),
        F.col(level).alias("congestion_level"))


def item(attr: str) -> Column:
    return F.when(F.col(attr).isNotNull(), F.concat(F.lit(f"{attr}="), F.col(attr).cast("string")))


def items_array(attrs: Sequence[str]) -> Column:
    """Sorted array of ``attribute=value`` items; null attributes give no item."""
    return F.array_sort(F.array_compact(F.array(*[item(a) for a in attrs])))


def itemsets(df: DataFrame, attrs: Sequence[str], min_support: float = 0.02) -> DataFrame:
    """Every frequent itemset with its count: ``items, n, n_total, support``.

    With one item per attribute an itemset is a cell of the attributes' cube.
    Rows are first counted by attribute combination, so the cube expands a few
    hundred combinations and never the table.
    """
    combos = df.groupBy(*attrs).agg(F.count("*").alias("_c"))
    total = fc.fitted(combos.agg(F.sum("_c").alias("n")))["n"]
    # null marks both "any" and "no value": keep only cells whose grouped-in
    # attributes all have a value
    cells = combos.cube(*attrs).agg(F.sum("_c").alias("n"), F.grouping_id().alias("_gid"))
    width = len(attrs)

    def fits(i: int) -> Column:
        rolled = F.col("_gid").bitwiseAND(F.lit(1 << (width - 1 - i))) != 0
        return rolled | F.col(attrs[i]).isNotNull()

    full = reduce(lambda a, b: a & b, [fits(i) for i in range(width)])
    return (cells.where(full & (F.col("_gid") != (1 << width) - 1))
            .select(items_array(attrs).alias("items"), "n", total.alias("n_total"))
            .withColumn("support", F.col("n") / F.col("n_total"))
            .where(F.col("support") >= min_support))


def itemsets_fpgrowth(df: DataFrame, attrs: Sequence[str],
                      min_support: float = 0.02) -> DataFrame:
    """The same itemsets from FP-growth, for attribute lists too long to cube."""
    baskets = df.select(items_array(attrs).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(baskets)
    total = fc.fitted(baskets.agg(F.count("*").alias("n")))["n"]
    return (model.freqItemsets
            .select(F.array_sort("items").alias("items"), F.col("freq").alias("n"),
                    total.alias("n_total"))
            .withColumn("support", F.col("n") / F.col("n_total")))


def rules(sets: DataFrame, consequent: str, min_lift: float = 1.2) -> DataFrame:
    """Rules whose consequent is one item of the attribute ``consequent``.

    An itemset with such an item splits one way: that item against the rest, so
    each rule needs two look-ups by itemset and no pairing of itemsets.
    """
    prefix = f"{consequent}="
    is_head = lambda i: i.startswith(prefix)          # noqa: E731
    key = lambda a: F.array_join(a, "|")              # noqa: E731
    joint = (sets.where(F.exists("items", is_head) & (F.size("items") > 1))
             .select(F.filter("items", lambda i: ~is_head(i)).alias("antecedent"),
                     F.filter("items", is_head)[0].alias("consequent"),
                     F.col("support").alias("support")))
    lookup = sets.select(key(F.col("items")).alias("_k"), F.col("support").alias("_s"))
    a = lookup.select(F.col("_k").alias("_ka"), F.col("_s").alias("antecedent_support"))
    c = lookup.select(F.col("_k").alias("_kc"), F.col("_s").alias("consequent_support"))
    return (joint.join(a, key(F.col("antecedent")) == F.col("_ka"))
            .join(c, F.col("consequent") == F.col("_kc"))
            .drop("_ka", "_kc")
            .withColumn("confidence", F.col("support") / F.col("antecedent_support"))
            .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
            .where(F.col("lift") >= min_lift))


def metrics(r: DataFrame) -> DataFrame:
    """The remaining rule metrics from the three supports."""
    a, c, s = (F.col(n) for n in ("antecedent_support", "consequent_support", "support"))
    certain = F.col("antecedent_support") == F.col("support")
    return r.withColumns({
        "representativity": F.lit(1.0),
        "leverage": s - a * c,
        "conviction": F.when(certain, F.lit(float("inf")))
                       .otherwise(F.try_divide(1 - c, 1 - s / a)),
        "zhangs_metric": F.coalesce(
            F.try_divide(s - a * c, F.greatest(s * (1 - a), a * (c - s))), F.lit(0.0)),
        "jaccard": F.try_divide(s, a + c - s),
        "certainty": F.coalesce(F.try_divide(s / a - c, 1 - c), F.lit(0.0)),
        "kulczynski": (s / a + s / c) / 2})


def top(r: DataFrame, k: int = 25) -> DataFrame:
    """Highest lift first, ties by text so that the order is total."""
    return (r.withColumn("antecedents", F.array_join("antecedent", ", "))
            .orderBy(F.desc(F.round("lift", 9)), "antecedents", "consequent").limit(k))


def sentence(r: DataFrame, consequent: str = "congestion_level",
             noun: str = "congestion") -> DataFrame:
    """Plain-language reading of each rule."""
    # fixed value: wording of a rule
    wording = "When %s, %s in %s%% of hours — %sx more likely than the base rate."
    return r.withColumn("plain_language", F.format_string(
        wording,
        F.replace(F.array_join("antecedent", ", "), F.lit("="), F.lit(" is ")),
        F.replace("consequent", F.lit(f"{consequent}="), F.lit(f"{noun} is ")),
        F.format_number(100 * F.round("confidence", 4), 0),
        F.format_number(F.round("lift", 3), 2)))


def covers(antecedent: Column, items: Column) -> Column:
    """True when every antecedent item is among the row's items."""
    return F.forall(antecedent, lambda i: F.array_contains(items, i))


