"""Descriptive statistics, correlation and probability."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlens.functions import columns as fc
from hourlens.functions.quantiles import quantiles
from hourlens.functions.ranks import average_ranks
from hourlens.session import work_dir
from hourlens.sources.sinks import write_stage


def describe(df: DataFrame, measure: str) -> DataFrame:
    """One row: count, mean, exact median, sample deviation and variance, range."""
    mid = fc.scalar(quantiles(df, measure, [0.5]).select("q"))["q"][0]
    return (df.agg(F.count(measure).alias("count"), F.avg(measure).alias("mean"),
                   F.stddev_samp(measure).alias("std"), F.var_samp(measure).alias("variance"),
                   F.min(measure).alias("min"), F.max(measure).alias("max"))
            .withColumn("range", F.col("max") - F.col("min")).withColumn("median", mid))


def quartiles(df: DataFrame, measure: str) -> DataFrame:
    return quantiles(df, measure, [0.25, 0.5, 0.75]).select(
        *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])


def skewness(df: DataFrame, measure: str) -> DataFrame:
    """Bias-corrected sample skewness (needs three rows)."""
    n = F.count(measure)
    factor = F.try_divide(F.sqrt(n * (n - 1).cast("double")), n - 2)
    return df.agg((F.skewness(measure) * factor).alias("skewness"))


def coef_variation(df: DataFrame, measure: str) -> DataFrame:
    return df.agg(fc.ratio(F.stddev_samp(measure), F.avg(measure)).alias("cv"))


def corr_pair(df: DataFrame, x: str, y: str, valid: Column) -> DataFrame:
    """Pearson r on all and on valid rows, with the determination coefficient."""
    xs, ys = F.when(valid, F.col(x)), F.when(valid, F.col(y))
    return df.agg(F.corr(x, y).alias("r_all"), F.corr(xs, ys).alias("r_valid"),
                  F.count_if(valid & F.col(x).isNotNull() & F.col(y).isNotNull())
                  .alias("n_valid")).withColumn("r2_valid", F.col("r_valid") ** 2)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full symmetric Pearson matrix in long form, pairwise complete, one scan.

    Each row is emitted once per column pair and combined before the shuffle;
    ten correlations side by side would compile to a method the JIT refuses.
    """
    pairs = list(combinations(columns, 2))
    cells = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(a).cast("double").alias("_x"),
                               F.col(b).cast("double").alias("_y"))
                      for i, (a, b) in enumerate(pairs)])
    names = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in pairs])
    r = (df.select(F.inline(cells)).groupBy("_i").agg(F.corr("_x", "_y").alias("r"))
         .withColumn("_p", F.element_at(names, F.col("_i") + 1)))
    both = F.array(F.struct(F.col("_p.x").alias("x"), F.col("_p.y").alias("y"), "r"),
                   F.struct(F.col("_p.y").alias("x"), F.col("_p.x").alias("y"), "r"))
    same = F.array(*[F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.lit(1.0).alias("r"))
                     for c in columns])
    # the first pair's row also carries the diagonal
    return r.select(F.inline(F.when(F.col("_i") == 0, F.concat(both, same)).otherwise(both)))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with tied ranks averaged.

    The rows are read once: their counted pairs are written, and both rank tables (one row per
    distinct value) and the size come from that.  AQE picks broadcast or a skew-split join.
    """
    base = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).alias("_x"), F.col(y).alias("_y"))
    spark = df.sparkSession
    counted = base.groupBy("_x", "_y").agg(F.count("*").alias("_w"))
    pairs = spark.read.schema(counted.schema).parquet(
        write_stage(counted, work_dir(spark, "pairs")))
    rx = average_ranks(pairs, "_x", "_w").select("_x", F.col("rank").alias("_rx"))
    ry = average_ranks(pairs, "_y", "_w").select("_y", F.col("rank").alias("_ry"))
    j = pairs.join(rx, "_x").join(ry, "_y")
    # both rank columns have mean (n + 1) / 2; centring keeps the sums accurate
    mid = fc.fitted(pairs.agg(((F.sum("_w") + 1) / 2.0).alias("m")))["m"]
    dx, dy, w = F.col("_rx") - mid, F.col("_ry") - mid, F.col("_w")
    return j.agg(F.sum(w * dx * dy).alias("xy"), F.sum(w * dx * dx).alias("xx"),
                 F.sum(w * dy * dy).alias("yy"), F.sum(w).alias("n")).select(
        fc.ratio("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"), "n")


def event_probabilities(df: DataFrame, a: Column, b: Column) -> DataFrame:
    both = F.coalesce(a & b, F.lit(False))
    return df.agg(F.count("*").alias("n"), fc.count_rows(a).alias("n_a"),
                  fc.count_rows(b).alias("n_b"), fc.count_rows(both).alias("n_ab")).select(
        "n", "n_a", "n_b", "n_ab", fc.ratio("n_a", "n").alias("p_a"),
        fc.ratio("n_b", "n").alias("p_b"), fc.ratio("n_ab", "n").alias("p_ab"))


def conditional_probability(df: DataFrame, given: Column, b: Column, c: Column) -> DataFrame:
    """P(b | given), P(c | given) beside the unconditional P(b), P(c)."""
    n_given = fc.count_rows(given)
    return df.agg(fc.ratio(fc.count_rows(given & b), n_given).alias("p_b_given_a"),
                  fc.ratio(fc.count_rows(given & c), n_given).alias("p_c_given_a"),
                  fc.mean_flag(b).alias("p_b"), fc.mean_flag(c).alias("p_c"))


def independence(df: DataFrame, a: Column, b: Column) -> DataFrame:
    p = event_probabilities(df, a, b)
    return p.select("p_ab", (F.col("p_a") * F.col("p_b")).alias("expected"),
                    (F.col("p_ab") - F.col("p_a") * F.col("p_b")).alias("difference"),
                    fc.ratio("p_ab", F.col("p_a") * F.col("p_b")).alias("observed_over_expected"))


def chi_square_2x2(df: DataFrame, a: Column, b: Column, yates: bool = True) -> DataFrame:
    """Chi-square of a 2x2 table, continuity-corrected by default, with its p-value."""
    p = event_probabilities(df, a, b)
    n = F.col("n").cast("double")
    na, nb, nab = (F.col(c).cast("double") for c in ("n_a", "n_b", "n_ab"))
    cells = [(nab, na * nb / n), (na - nab, na * (n - nb) / n),
             (nb - nab, (n - na) * nb / n), (n - na - nb + nab, (n - na) * (n - nb) / n)]

    def term(o: Column, e: Column) -> Column:
        gap = F.abs(o - e)
        gap = F.greatest(gap - 0.5, F.lit(0.0)) if yates else gap
        return F.try_divide(gap * gap, e)

    chi2 = term(*cells[0])
    for cell in cells[1:]:
        chi2 = chi2 + term(*cell)
    return p.select(chi2.alias("chi2"), F.lit(1).alias("dof")) \
            .withColumn("p_value", _normal_tail(F.sqrt("chi2")))


def odds_ratio(df: DataFrame, outcome: Column, column: str, left: str, right: str) -> DataFrame:
    def hits(value: str, cond: Column) -> Column:
        return fc.count_rows((F.col(column) == value) & cond)

    yes = F.coalesce(outcome, F.lit(False))
    return (df.agg(hits(left, yes).alias("a"), hits(left, ~yes).alias("b"),
                   hits(right, yes).alias("c"), hits(right, ~yes).alias("d"))
            .withColumn("odds_left", fc.ratio("a", "b"))
            .withColumn("odds_right", fc.ratio("c", "d"))
            .withColumn("odds_ratio", fc.ratio("odds_left", "odds_right"))
            .withColumn("reciprocal", fc.ratio("odds_right", "odds_left")))


# --- p-values: finishers applied to a one-row aggregate ----------------------
@F.pandas_udf(T.DoubleType())
def _normal_tail(z: pd.Series) -> pd.Series:
    """Two-sided normal tail; equals the chi-square tail with one degree of freedom."""
    return z.map(lambda v: None if v is None or math.isnan(v) else math.erfc(v / math.sqrt(2)))


def _log10_t_tail(t: float, dof: float) -> float:
    """log10 of the two-sided Student tail, by the continued fraction of the
    incomplete beta function; stays finite where the tail itself underflows."""
    if t == 0:
        return 0.0
    x, a, b = dof / (dof + t * t), dof / 2.0, 0.5
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        x, a, b = 1 - x, b, a
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            c = 1.0 + num / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    log_part = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) - math.log(a)
                + a * math.log(x) + b * math.log1p(-x) + math.log(h))
    if swap:
        rest = 1.0 - math.exp(log_part)
        return math.log10(rest) if rest > 0 else -math.inf
    return log_part / math.log(10)


@F.pandas_udf(T.DoubleType())
def _t_tail_log10(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if v is None or math.isnan(v) else _log10_t_tail(abs(v), k)
                      for v, k in zip(t, dof)], dtype="float64")


def pearson_pvalue(df: DataFrame, x: str, y: str) -> DataFrame:
    """r, its t statistic, and the two-sided p-value (also as a base-10 logarithm)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    row = df.where(both).agg(F.corr(x, y).alias("r"), F.count("*").alias("n"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") ** 2))
    return (row.withColumn("t", t)
            .withColumn("log10_p", _t_tail_log10(F.col("t"), (F.col("n") - 2).cast("double")))
            .withColumn("p_value", F.pow(F.lit(10.0), F.col("log10_p"))))
