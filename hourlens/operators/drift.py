"""Distribution and error drift between a reference and a current period."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions.quantiles import quantiles
from hourlens.session import work_dir
from hourlens.sources.sinks import write_stage

FLOOR = 1e-6        # fixed value: smallest share used in the index
FEW = 100_000       # values of a feature that one task ranks


def _long(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return wide.unpivot(list(keep), list(features), "feature", "x")


def value_counts(df: DataFrame, is_current: Column, features: Sequence[str]) -> DataFrame:
    """``feature, x, ref_n, cur_n``: rows of both periods per value, null included.

    Counted before the shuffle, so what travels is distinct values, of most features a few dozen."""
    long = _long(df.withColumn("_cur", is_current), features, ["_cur"])
    return long.groupBy("feature", "x").agg(F.count_if(~F.col("_cur")).alias("ref_n"),
                                            F.count_if(F.col("_cur")).alias("cur_n"))


def edges_from_counts(counted: DataFrame, ref: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """``feature, edges``: exact quantile edges of every feature's reference rows.

    Features of at most ``FEW`` values are ranked on their counts, the others from ``ref`` by brackets.
    Fitted once: the few rows (features x edges) become a local table."""
    probs = [i / bins for i in range(bins + 1)]
    counted = counted.where((F.col("ref_n") > 0) & F.col("x").isNotNull() & ~F.isnan("x"))
    sizes = {r["feature"]: (r["n"], r["kinds"]) for r in counted.groupBy("feature").agg(
        F.sum("ref_n").alias("n"), F.count("*").alias("kinds")).collect()}          # one row per feature
    few = [f for f, (_, kinds) in sizes.items() if kinds <= FEW]
    edges = {}
    if few:
        upto = Window.partitionBy("feature").orderBy("x").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        position = [F.lit(p) * (F.col("_n") - 1) for p in probs]
        wanted = F.array(*[f(k).cast("long") for k in position for f in (F.floor, F.ceil)])
        total = F.sum("ref_n").over(Window.partitionBy("feature"))
        ranked = counted.where(F.col("feature").isin(few)).withColumn("_end", F.sum("ref_n").over(upto)) \
            .withColumn("_n", total).withColumn("_at", F.explode(F.array_distinct(F.filter(
                wanted, lambda k: (k >= F.col("_end") - F.col("ref_n")) & (k < F.col("_end"))))))
        value = {(r["feature"], r["_at"]): r["x"] for r in ranked.select("feature", "_at", "x").collect()}
        for f in few:
            found = []
            for p in probs:
                at = p * (sizes[f][0] - 1)
                low, high = value[f, math.floor(at)], value[f, math.ceil(at)]
                found.append(low + (high - low) * (at - math.floor(at)))
            edges[f] = found
    many = [f for f in features if f in sizes and f not in edges]
    if many:
        q = quantiles(_long(ref, many), "x", probs, ["feature"], few_groups=True)
        edges |= {r["feature"]: r["q"] for r in q.collect()}
    return ref.sparkSession.createDataFrame(list(edges.items()), "feature string, edges array<double>")


def reference_edges(ref: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    return edges_from_counts(value_counts(ref, F.lit(False), features), ref, features, bins)


def _with_ids(edges: DataFrame) -> DataFrame:
    """Add the ends of the range and the id of the last bin."""
    last = F.element_at("edges", -1)
    return edges.select("feature", "edges", F.col("edges")[0].alias("_lo"), last.alias("_hi"),
                        F.size(F.filter("edges", lambda e: e < last)).alias("_last"))


def _bin(x: Column) -> Column:
    """Left-closed bin id (number of edges at or below x), last edge closed.

    Repeated edges are harmless: they merge into one id.  Outside is null.
    """
    inside = (x >= F.col("_lo")) & (x < F.col("_hi"))
    return F.when(x == F.col("_hi"), F.col("_last")).when(
        inside, F.size(F.filter("edges", lambda e: e <= x)))


def binned(counted: DataFrame, edges: DataFrame) -> DataFrame:
    """``feature, bin, ref_n, cur_n`` from value counts; bin null holds what is outside the range.

    The edges table has one row per feature of a fixed list and is broadcast."""
    tagged = counted.join(F.broadcast(_with_ids(edges)), "feature").withColumn("bin", _bin(F.col("x")))
    return tagged.groupBy("feature", "bin").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))


def with_empty_bins(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """``feature, bin, ref_n, cur_n, ref_total, cur_total`` with empty bins present."""
    ids = F.transform(F.array_distinct("edges"), lambda e: F.size(F.filter("edges", lambda g: g <= e)))
    spine = edges.select("feature", F.explode_outer(F.slice(ids, F.lit(1), F.size(ids) - 1)).alias("bin"))
    totals = counts.groupBy("feature").agg(F.sum("ref_n").alias("ref_total"), F.sum("cur_n").alias("cur_total"))
    named = counts.select(F.col("feature").alias("_f"), F.col("bin").alias("_b"), "ref_n", "cur_n")
    return (spine.join(named, (F.col("feature") == F.col("_f")) & F.col("bin").eqNullSafe(F.col("_b")), "left")
            .drop("_f", "_b").join(totals, "feature", "left").na.fill(0, ["ref_n", "cur_n"]))


def psi_from_bins(binned: DataFrame) -> DataFrame:
    """``feature, psi``; fewer than two bins cannot drift and give 0."""
    r = F.greatest(fc.ratio("ref_n", "ref_total"), F.lit(FLOOR))
    c = F.greatest(fc.ratio("cur_n", "cur_total"), F.lit(FLOOR))
    return binned.groupBy("feature").agg(
        F.when(F.count("bin") < 2, F.lit(0.0))
         .otherwise(F.sum((c - r) * F.log(c / r))).alias("psi"))


def psi(df: DataFrame, is_current: Column, features: Sequence[str], bins: int = 10) -> DataFrame:
    """``feature, psi``.  One scan counts the values of all features; edges and bins come from the counts."""
    counted = df.sparkSession.read.parquet(write_stage(
        value_counts(df, is_current, features), work_dir(df.sparkSession, "value-counts")))
    edges = edges_from_counts(counted, df.where(~is_current), features, bins)
    return psi_from_bins(with_empty_bins(binned(counted, edges), edges))


def feature_drift(psi_table: DataFrame, warn: float = config.PSI_WARN,
                  alert: float = config.PSI_ALERT) -> DataFrame:
    """Status per feature, with the roll-up repeated on every row."""
    banded = psi_table.withColumn("status", fc.status_band("psi", warn, alert))
    # one row per feature of a fixed list, so the global window is bounded
    every = Window.partitionBy()
    worst = F.max(fc.status_rank("status")).over(every)
    return banded.withColumn("overall_status", fc.status_name(worst)).withColumn(
        "n_drifted", F.count_if(F.col("status") != "PASS").over(every))


def top_drift(drift: DataFrame, k: int = 5) -> DataFrame:
    return (drift.where(F.col("status") != "PASS")
            .orderBy(F.desc(F.round("psi", 9)), "feature").limit(k))


def error_drift(df: DataFrame, is_current: Column, y: str = "y", p: str = "prediction",
                alert: float = config.ERROR_ALERT_RATIO) -> DataFrame:
    """MAE of both periods, their ratio (infinite on a perfect reference), status."""
    err = F.abs(F.col(p) - F.col(y))
    row = df.agg(F.avg(F.when(~is_current, err)).alias("reference_mae"),
                 F.avg(F.when(is_current, err)).alias("current_mae"))
    ratio = F.when(F.col("reference_mae") == 0, F.lit(float("inf"))) \
             .otherwise(fc.ratio("current_mae", "reference_mae"))
    return row.withColumn("ratio", ratio).withColumn("status",
                                                     fc.status_band("ratio", None, alert))


def report(df: DataFrame, is_current: Column, drift: DataFrame, errors: DataFrame,
           split_date: str, small: int = config.SMALL_WINDOW_ROWS) -> DataFrame:
    """The monitoring report as one nested row."""
    sizes = df.agg(F.count_if(~is_current).alias("reference_rows"),
                   F.count_if(is_current).alias("current_rows"))
    per_feature = F.map_from_entries(F.sort_array(F.collect_list(F.struct(
        "feature", F.struct(F.round("psi", 4).alias("psi"), "status")))))
    roll = drift.agg(
        F.max(fc.status_rank("status")).alias("worst"),
        F.count_if(F.col("status") != "PASS").alias("n_drifted"),
        per_feature.alias("per_feature"))
    one = errors.agg(*[F.first(c).alias(c) for c in ("status", "reference_mae", "current_mae",
                                                     "ratio")])
    sizes = sizes.withColumn("_f", fc.scalar(roll)).withColumn("_e", fc.scalar(one))
    roll, e = F.col("_f"), F.col("_e")
    worst = F.greatest(roll["worst"], fc.status_rank(e["status"]))
    return sizes.select(
        F.lit(split_date).alias("split_date"), "reference_rows", "current_rows",
        (F.col("current_rows") < small).alias("is_noisy"),
        F.struct(fc.status_name(roll["worst"]).alias("status"),
                 roll["n_drifted"].alias("n_drifted"),
                 roll["per_feature"].alias("per_feature")).alias("feature_drift"),
        F.struct(e["status"].alias("status"),
                 F.round(e["reference_mae"], 1).alias("reference_mae"),
                 F.round(e["current_mae"], 1).alias("current_mae"),
                 F.round(e["ratio"], 3).alias("ratio")).alias("error_drift"),
        fc.status_name(worst).alias("overall_status"))
