"""Shapley attributions of boosted trees that add up to the prediction.

A tree's prediction with only the features of a set known is the average over its leaves, where a split on an
unknown feature sends its training share both ways.  For one leaf of value v, let z_k be the product of the training
shares at the splits on feature k along its path, and o_k whether the row passes all of them (1 or 0).  With set S known
the leaf counts v * prod(o_k, k in S) * prod(z_k, k not in S).  A Shapley weight is an integral,
s! (m - s - 1)! / m! = int_0^1 t^s (1 - t)^(m - s - 1) dt, so summing over all sets gives one polynomial:

    phi_j = v (o_j - z_j) * int_0^1 prod_{k != j} (o_k t + z_k (1 - t)) dt

of degree m - 1 in t, integrated exactly at ceil(m / 2) Gauss points.  No subsets are listed, whatever the depth.

The forest becomes arrays of leaf paths (trees x leaves x path length numbers: as large as the model, whatever the
data) that are broadcast; rows pass through in Arrow batches.  Per row, the attributions and the base value add up
to the prediction.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.session import work_dir

CHUNK = 256         # rows by leaves by path features held at once


def leaf_paths(model: PipelineModel) -> dict[str, np.ndarray]:
    """Every leaf of the model's trees: value, and per path feature its number (-1: none), the
    interval (low, high] that leads here, and the training share z."""
    trees, spark = model.stages[-1], SparkSession.active()
    cut_at = next((s.getSplitsArray() for s in model.stages if isinstance(s, Bucketizer)), None)
    folder = work_dir(spark, "forest")
    trees.write().save(folder)
    nodes: dict[int, dict[int, tuple]] = {}
    saved = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*")
    for r in saved.collect():                               # the model's nodes
        split = r["split"]
        if r["leftChild"] >= 0 and split["numCategories"] != -1:
            raise ValueError("attribution knows numeric splits only")
        cut = split["leftCategoriesOrThreshold"][0] if r["leftChild"] >= 0 else None
        if cut is not None and cut_at:                      # of buckets: back to the feature's values
            cut = math.nextafter(cut_at[split["featureIndex"]][math.floor(cut) + 1], -math.inf)
        nodes.setdefault(r["treeID"], {})[r["id"]] = (
            r["leftChild"], r["rightChild"], split["featureIndex"], cut, r["impurityStats"][0], r["prediction"])
    leaves = []
    for tree, weight in enumerate(trees.treeWeights):
        held = nodes[tree]

        def walk(at: int, path: dict) -> None:
            left, right, feature, cut, rows, value = held[at]
            if left < 0:
                leaves.append((weight * value, path))
                return
            low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
            for child, span in ((left, (low, min(high, cut))), (right, (max(low, cut), high))):
                walk(child, path | {feature: (*span, share * held[child][4] / rows)})

        walk(0, {})
    width = max([1, *(len(p) for _, p in leaves)])
    out = {"value": np.array([v for v, _ in leaves]), "feature": np.full((len(leaves), width), -1),
           "low": np.full((len(leaves), width), -np.inf), "high": np.full((len(leaves), width), np.inf),
           "share": np.ones((len(leaves), width))}
    for i, (_, path) in enumerate(leaves):
        for k, (feature, (low, high, share)) in enumerate(path.items()):
            out["feature"][i, k], out["low"][i, k], out["high"][i, k], out["share"][i, k] = feature, low, high, share
    return out


def base_value(paths: dict[str, np.ndarray]) -> float:
    """What the model predicts with nothing known."""
    return float((paths["value"] * paths["share"].prod(axis=1)).sum())


def attributions(x: np.ndarray, paths: dict[str, np.ndarray]) -> np.ndarray:
    """Rows by features: the attribution of every feature to every prediction."""
    leaves, width = paths["feature"].shape
    spots, weights = np.polynomial.legendre.leggauss((width + 1) // 2)
    spots, weights = (spots + 1) / 2, weights / 2
    out = np.zeros(x.shape)
    real = paths["feature"] >= 0
    at = np.where(real, paths["feature"], 0)
    rows = max(1, CHUNK * 4096 // (leaves * width))
    for a in range(0, len(x), rows):
        part = x[a:a + rows]
        seen = part[:, at]                                  # rows, leaves, path features
        passed = ((seen > paths["low"]) & (seen <= paths["high"])) | ~real
        total = np.zeros(passed.shape)
        for t, w in zip(spots, weights):
            # an unused place has o = z = 1 and changes nothing
            factor = passed * t + paths["share"] * (1 - t)
            total += w * factor.prod(axis=2, keepdims=True) / factor
        phi = paths["value"][:, None] * (passed - paths["share"]) * total
        for f in range(x.shape[1]):
            out[a:a + rows, f] = phi[:, (paths["feature"] == f)].sum(axis=1)
    return out


def explain(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, base, attribution (array, in the order of ``features``) and prediction of every row."""
    paths = leaf_paths(model)
    base, held = base_value(paths), df.sparkSession.sparkContext.broadcast(paths)
    scored = model.transform(df).select(
        *keep, F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), "prediction")

    def run(batches):
        for batch in batches:
            x = batch["_x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(features))
            phi = attributions(x, held.value)
            offs = pa.array(np.arange(len(x) + 1) * len(features), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in keep], pa.array(np.full(len(x), base)),
                 pa.ListArray.from_arrays(offs, pa.array(phi.reshape(-1))), batch["prediction"]],
                [*keep, "base", "attribution", "prediction"])

    kinds = "".join(f"`{c}` {t}, " for c, t in scored.select(*keep).dtypes)
    return scored.mapInArrow(run, f"{kinds}base double, attribution array<double>, prediction double")


def grouped(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row, with their number ``n``, for the rows that lie in the same buckets: their attributions are the same."""
    cut = next(s for s in model.stages if isinstance(s, Bucketizer))
    return cut.transform(df.select(*features)).groupBy(*cut.getOutputCols()).agg(
        F.count("*").alias("n"), *[F.min(f).alias(f) for f in features]).select(*features, "n")


def mean_attribution(explained: DataFrame, features: Sequence[str], n: str | None = None) -> DataFrame:
    """``feature, mean_abs``: the mean size of each feature's attribution over all rows; ``n`` is a column of row counts."""
    rows = F.col(n) if n else F.lit(1)
    names = F.array(*[F.lit(f) for f in features])
    return explained.select(rows.alias("n"), F.explode(F.arrays_zip(
        names.alias("feature"), F.col("attribution").alias("phi"))).alias("a")).groupBy("a.feature").agg(
        (F.sum(F.abs("a.phi") * F.col("n")) / F.sum("n")).alias("mean_abs"))
