"""Metrics over tables of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.functions.ranks import range_bucket


def _cells(y: str, p: str) -> list[Column]:
    return [fc.count_rows((F.col(y) == yy) & (F.col(p) == pp)).alias(name)
            for name, yy, pp in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))]


def confusion(df: DataFrame, y: str = "y", p: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_cells(y, p))


def precision_recall(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1; an empty denominator gives 0."""
    def safe(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num, den), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (cells.withColumn("accuracy", safe(tp + tn, tp + tn + fp + fn))
            .withColumn("precision", safe(tp, tp + fp))
            .withColumn("recall", safe(tp, tp + fn))
            .withColumn("f1", safe(2 * tp, 2 * tp + fp + fn)))


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Area under the ROC curve by rank sum, ties counted half.

    Scores are counted by distinct value, ranked inside order-preserving
    ranges, and the ranges are stitched with one short running total.  Rows
    without a score or a label are left out.
    """
    counts = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.col(y).cast("bigint")).alias("_pos"),
        F.sum((1 - F.col(y)).cast("bigint")).alias("_neg"))
    tagged = range_bucket(counts, "_s")
    below = F.coalesce(F.sum("_neg").over(
        Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    local = tagged.withColumn("_wins", F.col("_pos") * (below + F.col("_neg") / 2.0))
    buckets = local.groupBy("_b").agg(F.sum("_wins").alias("_wins"), F.sum("_pos").alias("_pos"),
                                      F.sum("_neg").alias("_neg"))
    # one row per bucket: the ordered total runs in one task by design
    lower = F.coalesce(F.sum("_neg").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (buckets.withColumn("_wins", F.col("_wins") + F.col("_pos") * lower)
            .agg(F.sum("_wins").alias("w"), F.sum("_pos").alias("n_positive"),
                 F.sum("_neg").alias("n_negative"))
            .select(fc.ratio("w", F.col("n_positive").cast("double") * F.col("n_negative"))
                    .alias("roc_auc"), "n_positive", "n_negative"))


def regression_metrics(df: DataFrame, y: str = "y", p: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 (against the mean of the evaluated rows) in one pass."""
    err = F.col(p) - F.col(y)
    return (df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"))
        .withColumn("r2", 1 - fc.ratio("_sse", "_sst")).drop("_sse", "_sst"))


def majority_baseline(df: DataFrame, y: str = "y") -> DataFrame:
    return df.agg((1 - F.avg(y)).alias("baseline_accuracy"))


def mean_baseline(df: DataFrame, y: str = "y", is_test: str = "is_test") -> DataFrame:
    """MAE on the test rows of always predicting the training mean."""
    mean = fc.scalar(df.where(~F.col(is_test)).agg(F.avg(y).alias("m")))["m"]
    return df.where(F.col(is_test)).agg(F.avg(F.abs(F.col(y) - mean)).alias("baseline_mae"))


def improvement(baseline: DataFrame, mae: Column) -> DataFrame:
    return baseline.withColumn("pct_better", fc.ratio(
        F.lit(100.0) * (F.col("baseline_mae") - mae), F.col("baseline_mae")))


def best_by(metrics: DataFrame, model: str, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """The best model per group, the first name on a tie."""
    pick = F.min_by(F.struct(F.col(model), F.col(metric)),
                    F.struct((-F.col(metric)).alias("m"), F.col(model).alias("k")))
    return (metrics.groupBy(*by).agg(pick.alias("_b"))
            .select(*by, F.col(f"_b.{model}").alias("best_model"),
                    F.col(f"_b.{metric}").alias("best_value")))


def by_slice(df: DataFrame, slices: Sequence[str], y: str = "y",
             p: str = "prediction") -> DataFrame:
    """Regression error per slice value, all slice columns from one scan."""
    long = df.select(y, p, *[F.col(s).cast("string").alias(s) for s in slices]) \
             .unpivot([y, p], list(slices), "slice", "level")
    return regression_metrics(long, y, p, ["slice", "level"])
