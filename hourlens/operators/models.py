"""Spark ML fits, scoring, forecasting and attribution."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.operators import forest
from hourlens.operators.features import with_class_weight
from hourlens.operators.relational import hash_order
from hourlens.session import work_dir
from hourlens.sources.sinks import write_stage


def ensure_checkpoint(spark: SparkSession) -> None:
    """Boosting cuts its lineage with checkpoints; give it the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoint"))


def assemble(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def feature_gaps(df: DataFrame, features: Sequence[str]) -> list[str]:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise KeyError(f"missing feature columns: {missing}")
    return missing


ROWS = 200_000          # training rows of a task
VALUES = 4096           # counted values of a feature that the driver takes
GROUPS = 2_000_000      # groups of equal buckets that a task holds
UNITS = 10              # parts of a bucket's rows that are drawn on their own


def tasks(rows: DataFrame) -> int:
    """Tasks of about ``ROWS`` rows, one per core at least."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / ROWS))


def dealt(rows: DataFrame) -> DataFrame:
    """Training rows in tasks of about ``ROWS``.

    Fits read them many times in the partitions they come in, and those follow compressed bytes: a file of
    millions of rows may be one partition."""
    return rows.repartition(tasks(rows))


def fit_logistic(train: DataFrame, features: Sequence[str], label: str,
                 max_iter: int = 1000) -> PipelineModel:
    """Scaled logistic regression with balanced classes and unit L2 strength.

    Balanced weights sum to the row count, so the penalty per unit of weight
    is one over the row count.
    """
    feature_gaps(train, features)
    weighted = with_class_weight(train, label)
    n = train.count()           # a footer count where ``train`` is a written table
    return Pipeline(stages=[
        assemble(features, "raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(labelCol=label, weightCol="weight", maxIter=max_iter,
                           regParam=1.0 / max(n, 1), elasticNetParam=0.0, tol=1e-4,
                           standardization=False)]).fit(dealt(weighted))


def fit_forest(train: DataFrame, features: Sequence[str], label: str, trees: int = 200,
               depth: int = 18, min_leaf: int = 5, seed: int = config.SEED) -> PipelineModel:
    """Random forest with balanced classes.

    Spark's own fit keeps, for every row, its draws and its node in every tree (1,600 bytes a row with 200 trees, and the
    nodes again in checkpoints).  So rows are grouped by buckets, and tasks grow whole trees from the groups
    (``operators/forest.py``).  Only beyond ``GROUPS`` groups, more than a task should hold, Spark fits row by row."""
    feature_gaps(train, features)
    spark = train.sparkSession
    weighted = with_class_weight(train, label)
    learner = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees,
                                     maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
                                     maxMemoryInMB=1024, cacheNodeIds=True)
    cut = bucketizer(train, features)
    y = F.when(F.col(label).isin(0, 1), F.col(label).cast("int")).otherwise(
        F.raise_error(F.lit(f"{label} is not 0 or 1")).cast("int"))
    groups = cut.transform(weighted.select(label, "weight", *features)).groupBy(
        forest.code(cut.getOutputCols()).alias("code"), y.alias("y"), "weight").agg(F.count("*").alias("n"))
    stage = spark.read.parquet(write_stage(groups, work_dir(spark, "groups")))
    held = stage.count()
    if held > GROUPS:
        ensure_checkpoint(spark)
        # deep trees: remembering each row's node spares walking every tree per level
        return Pipeline(stages=[assemble(features), learner]).fit(dealt(weighted))
    if not held:
        raise ValueError("no training rows")
    # two rows, one a class, give a model of the right shape and settings
    two = spark.createDataFrame([(*[float(i)] * len(features), i, 1.0) for i in (0, 1)],
                                ", ".join([*(f"`{f}` double" for f in features), f"`{label}` int", "weight double"]))
    shell = Pipeline(stages=[assemble(features), learner]).fit(two)
    found = forest.nodes(stage, cut.getSplitsArray(), trees, depth, min_leaf, seed)
    return PipelineModel(stages=[shell.stages[0], forest.as_model(shell.stages[1], found)])


def fit_linear(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    feature_gaps(train, features)
    return Pipeline(stages=[
        assemble(features, "raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LinearRegression(labelCol=label, solver="normal")]).fit(train)


def _cuts(values: Sequence[tuple[float, int]], bins: int) -> list[float]:
    """Where trees may cut a feature, from its counted values: between all of them, or after about equal shares."""
    if len(values) <= bins:
        return [(a + b) / 2 for (a, _), (b, _) in zip(values, values[1:])]
    stride = sum(n for _, n in values) / bins
    out, seen, goal = [], values[0][1], stride
    for (a, _), (b, n) in zip(values, values[1:]):
        if abs(seen - goal) < abs(seen + n - goal):
            out.append((a + b) / 2)
            goal += stride
        seen += n
    return out


def bucketizer(train: DataFrame, features: Sequence[str], bins: int = 32) -> Bucketizer:
    """Buckets ``_b_<feature>`` between the places where trees of ``bins`` bins may cut.

    Features of at most ``VALUES`` values are cut by the counts of all of them, others at quantiles of all rows."""
    named = train.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("v")) for f in features])).alias("p")).select("p.*")
    counts = named.groupBy("f", "v").agg(F.count("*").alias("n")).persist()
    sizes = {r["f"]: r["count"] for r in counts.groupBy("f").count().collect()}
    few = [f for f in features if sizes.get(f, 0) <= VALUES]
    held: dict[str, list] = {f: [] for f in features}
    for r in counts.where(F.col("f").isin(few)).collect():      # at most features x VALUES rows
        if r["v"] is not None:
            held[r["f"]].append((r["v"], r["n"]))
    counts.unpersist()
    many = [f for f in features if f not in few]
    steps = [i / bins for i in range(1, bins)]
    marks = train.agg(*[F.percentile_approx(F.col(f).cast("double"), steps, 10_000).alias(f) for f in many]).first() \
        if many else {}
    ends = [_cuts(sorted(held[f]), bins) if f in few else sorted(set(marks[f])) for f in features]
    # a cut belongs to the left in trees, to the right in buckets
    splits = [[-math.inf, *[math.nextafter(v, math.inf) for v in e or [0.0]], math.inf] for e in ends]
    return Bucketizer(inputCols=list(features), outputCols=[f"_b_{f}" for f in features], splitsArray=splits)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str, trees: int = 300,
            depth: int = 5, rate: float = 0.1, subsample: float = 0.9,
            seed: int = config.SEED) -> PipelineModel:
    """Boosting of squared errors.

    Trees see rows through the buckets of their features only, so rows of the same buckets count as one with their mean
    and number: sums of squares inside such a group are the same on both sides of every split, and the trees are those of the
    single rows.  With ``subsample``, a group is ``UNITS`` parts drawn on their own.  What is boosted is bounded by the
    buckets that occur, however many rows there are."""
    feature_gaps(train, features)
    ensure_checkpoint(train.sparkSession)
    cut = bucketizer(train, features)
    names = cut.getOutputCols()
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(label), *features), F.lit(UNITS)) if subsample < 1 else F.lit(0)
    # adding 0 drops the mark of a category: buckets stay in order
    units = cut.transform(train.select(label, *features)).groupBy(
        *[(F.col(n) + 0.0).alias(n) for n in names], unit.alias("_unit")).agg(F.avg(F.col(label).cast("double")).alias("_y"), F.count("*").cast("double").alias("_n"))
    stage = train.sparkSession.read.parquet(write_stage(units, work_dir(train.sparkSession, "units")))
    boosted = Pipeline(stages=[assemble(names), GBTRegressor(
        labelCol="_y", weightCol="_n", maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
        seed=seed, maxMemoryInMB=1024)]).fit(dealt(stage))
    return PipelineModel(stages=[cut, *boosted.stages])


def fit_surrogate(train: DataFrame, features: Sequence[str], label: str,
                  trees: int = 200) -> PipelineModel:
    """The boosting model that stands in for attribution (no row subsampling)."""
    return fit_gbt(train, features, label, trees=trees, subsample=1.0)


# --- scoring ----------------------------------------------------------------
def score_regression(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, "prediction")


def score_risk(model: PipelineModel, df: DataFrame, keep: Sequence[str],
               threshold: float = 0.5) -> DataFrame:
    """Probability of the positive class, its label, and the fixed proxy note."""
    p = vector_to_array("probability")[1]
    return (model.transform(df).select(*keep, p.alias("score"))
            .withColumn("high_risk_probability", F.round("score", 4))
            .withColumn("label", (F.col("score") >= threshold).cast("int"))
            .withColumn("note", F.lit(config.PROXY_NOTE)))


# --- forecasting ------------------------------------------------------------
def lag_features(history: DataFrame, columns: Sequence[str], steps: int = config.HISTORY_STEPS,
                 out: str = "lags") -> DataFrame:
    """Flatten a history array into one vector, oldest hour first."""
    flat = F.flatten(F.transform("history", lambda h: F.array(
        *[h[c].cast("double") for c in columns])))
    return history.withColumn(out, array_to_vector(flat))


def fit_forecast(train: DataFrame, label: str = "target", booster: bool = False,
                 trees: int = 50) -> PipelineModel:
    """Next-step model on the lag vector; scaling is learned on training rows only."""
    scaler = StandardScaler(inputCol="lags", outputCol="features", withMean=True, withStd=True)
    if booster:
        ensure_checkpoint(train.sparkSession)
        learner = GBTRegressor(labelCol=label, maxIter=trees, maxDepth=5, stepSize=0.1,
                               seed=config.SEED, maxMemoryInMB=1024)
    else:
        learner = LinearRegression(labelCol=label, solver="normal", regParam=0.1)
    return Pipeline(stages=[scaler, learner]).fit(train)


def error_history(model: PipelineModel, train: DataFrame, test: DataFrame,
                  metric: str = "absolute") -> DataFrame:
    """Mean train and test loss after each boosting iteration."""
    gbt = next(s for s in model.stages if isinstance(s, GBTRegressionModel))

    def losses(rows: DataFrame) -> list[float]:
        prepared = reduce(lambda d, s: s.transform(d), [s for s in model.stages if s is not gbt], rows)
        return [float(v) for v in gbt.evaluateEachIteration(prepared, metric)]

    pairs = zip(losses(train), losses(test))
    return test.sparkSession.createDataFrame(
        [(i + 1, a, b) for i, (a, b) in enumerate(pairs)],
        "iteration int, train_mae double, test_mae double")


# --- attribution ------------------------------------------------------------
def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str],
                           label: str, key: str, bucket_rows: int = 20_000,
                           seed: int = config.SEED) -> DataFrame:
    """Mean increase of the absolute error when one feature is permuted, over all rows of ``df``.

    Rows are dealt by hash into buckets of about ``bucket_rows``.  Inside a bucket, a feature is
    permuted by handing each row the value of the next row in an order drawn by hash for
    that feature; all features are scored in one job.
    """
    rows = df.select(key, label, *features)
    buckets = max(1, math.ceil(rows.count() / bucket_rows))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)))
    shifted = {}
    for i, f in enumerate(features):
        w = Window.partitionBy("_bucket").orderBy(hash_order(key, seed + 1 + i), F.col(key))
        wrap = F.first(f).over(w.rowsBetween(Window.unboundedPreceding,
                                             Window.unboundedFollowing))
        shifted[f"_p_{f}"] = F.coalesce(F.lead(f).over(w), wrap)
    wide = dealt.withColumns(shifted)
    variants = [F.struct(F.lit("").alias("feature"), *[F.col(f).alias(f) for f in features])]
    for g in features:
        variants.append(F.struct(F.lit(g).alias("feature"), *[
            F.col(f"_p_{f}" if f == g else f).alias(f) for f in features]))
    table = wide.select(F.col(label).alias("_y"), F.inline(F.array(*variants)))
    scored = model.transform(table)
    mae = scored.groupBy("feature").agg(F.avg(F.abs(F.col("prediction") - F.col("_y")))
                                        .alias("mae"))
    base = fc.scalar(mae.where("feature = ''").agg(F.max("mae").alias("m")))["m"]
    return (mae.where("feature != ''")
            .select("feature", (F.col("mae") - base).alias("importance")))


def split_importance(model: PipelineModel, features: Sequence[str],
                     spark: SparkSession) -> DataFrame:
    """Impurity importances of the fitted trees."""
    tree = model.stages[-1]
    values = tree.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)],
                                 "feature string, importance double")
