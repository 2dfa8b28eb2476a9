"""K-means on standardised conditions, model selection and interpretation."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions.quantiles import median
from hourlens.operators.features import scaling_stats
from hourlens.session import work_dir
from hourlens.sources.sinks import write_stage

MAX_ITER, TOL = 300, 1e-4
START_ROWS = 4096       # rows that starting centres are drawn from
ROWS = 2048             # rows by centres held at once
TASK_ROWS = 200_000     # distinct vectors of a task


def with_severity(df: DataFrame, category: str = "weather_main",
                  ranks: Mapping[str, int] = config.CLUSTER_SEVERITY) -> DataFrame:
    """Add ``severity``, the category's rank as a clustering feature; others rank 0."""
    return df.withColumn("severity", fc.ordinal(category, ranks, 0))


def scaled_vector(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Standardise with the population deviation and pack into a vector.

    A feature that never varies is 0; a null feature is an error, not the mean.
    """
    s = fc.fitted(scaling_stats(df, features))
    cells = [F.when(F.col(f).isNull(), F.raise_error(F.lit(f"null in clustering feature {f}")).cast(
        "double")).otherwise(F.coalesce(fc.ratio(F.col(f) - s[f"{f}_mean"], s[f"{f}_std"]), F.lit(0.0)))
             for f in features]
    return df.withColumn(out, array_to_vector(F.array(*cells)))


class Centres:
    """A fitted K-means model: its centres, the sum of squared distances to them, and assignment."""

    def __init__(self, centres: np.ndarray, cost: float):
        self.centres, self.cost = centres, cost

    def transform(self, df: DataFrame, features: str = "features", out: str = "cluster") -> DataFrame:
        """Add the number of the nearest centre, the first one on a tie."""
        x = F.col("_x")
        away = [F.struct(sum(((x[i] - float(v)) * (x[i] - float(v)) for i, v in enumerate(c)), F.lit(0.0)).alias("d"),
                         F.lit(k).alias("k")) for k, c in enumerate(self.centres)]
        return df.withColumn("_x", vector_to_array(features)).withColumn(
            out, F.array_min(F.array(*away))["k"]).drop("_x")


def kmeans(df: DataFrame, k: int, restarts: int = 10, seed: int = config.SEED,
           max_iter: int = MAX_ITER) -> Centres:
    """Best of several starts, by cost.  ``df`` has a features vector."""
    return _best_models(df, [k], restarts, seed, max_iter)[k]


def starts(data: DataFrame, ks: Iterable[int], restarts: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """Starting centres of every (k, start): rows of a hashed sample drawn with chances by squared distance.

    At most ``START_ROWS`` rows come to the driver; what is fitted are all rows."""
    few = data.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(START_ROWS).collect()
    sample, out = np.array([r["x"] for r in few], float), {}
    for k in ks:
        for r in range(restarts):
            rng = np.random.default_rng((seed, k, r))
            chosen = [sample[rng.integers(len(sample))]]
            near = ((sample - chosen[0]) ** 2).sum(axis=1)
            while len(chosen) < k:
                total = near.sum()
                at = rng.choice(len(sample), p=near / total) if total > 0 else rng.integers(len(sample))
                chosen.append(sample[at])
                near = np.minimum(near, ((sample - chosen[-1]) ** 2).sum(axis=1))
            out[k, r] = np.array(chosen)
    return out


def fit_many(data: DataFrame, begun: dict, max_iter: int = MAX_ITER, tol: float = TOL) -> dict:
    """Lloyd's rounds of many models side by side; ``data`` has rows of an array ``x`` and, if equal rows
    are counted, their number ``w``.

    A pass over the rows assigns each to its centre in every unfinished model and sums rows, coordinates and
    cost by (model, cluster) inside each task; what comes to the driver is one small row per task, model and
    cluster.  A model is finished once its centres move, squared and summed, by no more than ``tol`` times the mean
    variance of a coordinate; a cluster without rows keeps its centre."""
    spark = data.sparkSession
    weighted = data.select("x", (F.col("w") if "w" in data.columns else F.lit(1)).cast("double").alias("w"))
    centres, cost = {m: c.astype(float) for m, c in begun.items()}, {}
    open_ = list(centres)
    for step in range(max_iter + 1):
        held = spark.sparkContext.broadcast([centres[m] for m in open_])

        def add(batches, held=held):
            models = held.value
            laid = np.concatenate(models)
            count, square, whole = 0, 0.0, np.zeros(laid.shape[1])
            begin = np.cumsum([0, *map(len, models)])
            rows, sums, away = np.zeros(len(laid)), np.zeros(laid.shape), np.zeros(len(laid))
            for batch in batches:
                flat = batch["x"].flatten().to_numpy(zero_copy_only=False)
                x = flat.reshape(batch.num_rows, -1)
                w = batch["w"].to_numpy()
                count, square, whole = count + w.sum(), square + float((w @ (x * x)).sum()), whole + w @ x
                for a in range(0, len(x), ROWS):
                    part = x[a:a + ROWS]
                    far = (part * part).sum(axis=1)[:, None] - 2 * part @ laid.T + (laid * laid).sum(axis=1)
                    hit = np.zeros((len(part), len(laid)))
                    line, n = np.arange(len(part)), w[a:a + ROWS]
                    for lo, hi in zip(begin, begin[1:]):
                        hit[line, lo + far[:, lo:hi].argmin(axis=1)] = n
                    rows += hit.sum(axis=0)
                    sums += hit.T @ part
                    away += np.einsum("ij,ij->j", hit, np.maximum(far, 0, out=far))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(laid) + 1)), pa.array(np.append(rows, count)),
                 pa.array(np.append(away, square)), pa.array([*sums, whole])], ["at", "n", "cost", "total"])

        found = weighted.mapInArrow(add, "at long, n double, cost double, total array<double>").collect()
        held.destroy()
        size = 1 + sum(len(centres[m]) for m in open_)      # the last one stands for all rows
        n, spent, total = np.zeros(size), np.zeros(size), np.zeros((size, len(found[0]["total"])))
        for r in found:                                     # tasks x clusters of unfinished models
            n[r["at"]] += r["n"]
            spent[r["at"]] += r["cost"]
            total[r["at"]] += r["total"]
        spread = (spent[-1] - (total[-1] ** 2).sum() / max(n[-1], 1)) / max(n[-1], 1) / total.shape[1]
        at, left = 0, []
        for m in open_:
            own = slice(at, at + len(centres[m]))
            at = own.stop
            cost[m] = float(spent[own].sum())
            new = np.where(n[own][:, None] > 0, total[own] / np.maximum(n[own], 1)[:, None], centres[m])
            if ((new - centres[m]) ** 2).sum() > tol * spread and step < max_iter:
                centres[m] = new
                left.append(m)
        open_ = left
        if not open_:
            break
    return {m: Centres(centres[m], cost[m]) for m in centres}


def _best_models(df: DataFrame, ks: Iterable[int], restarts: int, seed: int, max_iter: int) -> dict[int, Centres]:
    """All (k, start) pairs in one loop over a written table of the vectors; the cheapest start of each k."""
    spark, ks = df.sparkSession, list(ks)
    # equal vectors are one with their number; dealt by rows, as a file of few bytes may hold many of them
    vectors = df.select(vector_to_array("features").alias("x")).groupBy("x").agg(F.count("*").alias("w"))
    stage = spark.read.parquet(write_stage(vectors, work_dir(spark, "vectors")))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(stage.count() / TASK_ROWS))
    data = stage.repartition(tasks).persist()
    # starting centres are drawn from rows, so that equal ones keep their chances
    done = fit_many(data, starts(data.select(F.explode(F.array_repeat("x", F.least("w", F.lit(START_ROWS)).cast("int")))
                                             .alias("x")), ks, restarts, seed), max_iter)
    data.unpersist()
    return {k: min((done[k, r] for r in range(restarts)), key=lambda c: c.cost) for k in ks}


def _cluster_sums(points: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per cluster: rows, sum of each coordinate, sum of squared lengths.  One small row each."""
    square = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))
    return points.groupBy("_label").agg(
        F.count("*").alias("n"), F.array(*[F.sum(c) for c in names]).alias("total"),
        F.sum(square).alias("square"))


def silhouette_points(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Silhouette of every row under squared Euclidean distance: ``label, silhouette``.

    The mean squared distance to a cluster follows from its row count, coordinate sums and
    sum of squares, so two passes over the rows suffice, whatever their number.
    Coordinates are taken from the overall mean, which keeps the sums small.
    """
    names = [f"_x{i}" for i in range(len(features))]
    mean = fc.fitted(df.agg(*[F.avg(F.col(f).cast("double")).alias(f"m{i}")
                              for i, f in enumerate(features)]))
    points = df.select(F.col(label).alias("_label"), *[
        (F.col(f).cast("double") - mean[f"m{i}"]).alias(n)
        for i, (f, n) in enumerate(zip(features, names))])
    sums = _cluster_sums(points, names).agg(
        F.collect_list(F.struct("_label", "n", "total", "square")).alias("clusters"))
    own_square = sum((F.col(c) * F.col(c) for c in names), F.lit(0.0))

    def away(c: Column) -> Column:
        dot = sum((F.col(n) * c["total"][i] for i, n in enumerate(names)), F.lit(0.0))
        return F.greatest(F.lit(0.0), F.col("_sq") - 2 * dot / c["n"] + c["square"] / c["n"])

    far = points.withColumn("_sq", own_square).withColumn("_all", fc.scalar(sums)["clusters"])
    far = far.withColumn("_far", F.transform("_all", lambda c: F.struct(
        c["_label"].alias("label"), c["n"].alias("n"), away(c).alias("d"))))
    mine = F.filter("_far", lambda c: c["label"] == F.col("_label"))[0]
    other = F.array_min(F.transform(F.filter(
        "_far", lambda c: c["label"] != F.col("_label")), lambda c: c["d"]))
    near = mine["d"] * mine["n"] / (mine["n"] - 1)
    value = F.when((mine["n"] > 1) & other.isNotNull() & (F.greatest(near, other) > 0),
                   (other - near) / F.greatest(near, other)).otherwise(F.lit(0.0))
    return far.select(F.col("_label").alias("label"), value.alias("silhouette"))


def silhouette(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return silhouette_points(df, features, label).agg(
        F.avg("silhouette").alias("silhouette"), F.count("*").alias("n"))


def select_k(df: DataFrame, features: Sequence[str], ks: Iterable[int] = range(2, 9),
             restarts: int = 10, seed: int = config.SEED, parallelism: int = 8,
             max_iter: int = MAX_ITER) -> tuple[DataFrame, dict[int, Centres]]:
    """Silhouette per k and the fitted models, both over all rows."""
    ks = list(ks)
    vec = scaled_vector(df, features)
    models = _best_models(vec, ks, restarts, seed, max_iter)
    names = [f"_x{i}" for i in range(len(features))]

    def score(k: int) -> tuple[int, float, int]:
        labelled = models[k].transform(vec.select("features")).withColumn(
            "_a", vector_to_array("features"))
        row = silhouette(labelled.select(*[F.col("_a")[i].alias(n) for i, n in enumerate(names)],
                                         "cluster"), names, "cluster").first()
        return k, float(row["silhouette"]), int(row["n"])

    with ThreadPool(parallelism) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(score), ks)
    best = max(rows, key=lambda r: (r[1], -r[0]))[0]
    table = df.sparkSession.createDataFrame(
        [(k, s, n, k == best) for k, s, n in rows],
        "k int, silhouette double, n bigint, is_best boolean")
    return table, models


def interpret(profile: DataFrame, overall_median: Column) -> DataFrame:
    """Profile row to text; compares the rounded profile with the overall median."""
    h, v = F.col("mean_hour"), F.col("mean_measure")
    # fixed values: wording of a cluster description
    when = (F.when(h < 6, "overnight").when(h < 11, "morning").when(h < 15, "midday")
             .when(h < 20, "afternoon/evening").otherwise("late evening"))
    load = F.when(v > overall_median, "high-volume").otherwise("low-volume")
    weather = F.when(F.col("mean_severity") > 2, "adverse weather").otherwise("mild weather")
    day = F.when(F.col("weekend_share") > 0.5, "mostly weekend").otherwise("mostly weekday")
    return profile.withColumn("interpretation", F.format_string(
        "%s %s hours, %s, %s (n=%s, mean volume %s)", load, when, day, weather,
        fc.thousands("n"), F.regexp_replace(fc.thousands(v), ",", "")))


def overall_median(df: DataFrame, measure: str) -> Column:
    return fc.scalar(median(df, measure))["median"]
