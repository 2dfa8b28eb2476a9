"""Random forests from rows grouped by the buckets of their features.

Trees see rows through the buckets of their features only, so rows of the same buckets and label are one group with their
number: a group that stands for n rows is drawn Poisson(n) times by a tree, which is the sum of n draws of single rows, and
every count behind a split is that of the single rows.  Groups are bounded by the buckets that occur, not by the rows.

Tasks grow whole trees, level by level, each from all groups.  The rules are those of Spark's forest: weighted Gini, a
new draw of features at every node, at least ``min_leaf`` drawn rows a side, leaves of one prediction joined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens.session import work_dir

NODES = 16_384          # nodes whose counts are held at once
FIRST = 33              # character of bucket 0
NODE = ("tree int, id int, prediction double, impurity double, none double, one double, rows long, gain double, "
        "lower int, upper int, feature int, threshold double")


def code(buckets: Sequence[str]) -> Column:
    """The buckets of a row as text, a character each."""
    return F.concat(*[F.when(F.col(b).isNull(), F.raise_error(F.lit(f"null in feature {b}")).cast("string"))
                      .otherwise(F.char(F.col(b).cast("int") + FIRST)) for b in buckets])


def _best(x: np.ndarray, node: np.ndarray, y: np.ndarray, drawn: np.ndarray, mass: np.ndarray, picked: np.ndarray,
          weights: np.ndarray, rows: np.ndarray, bins: int, min_leaf: int) -> tuple[np.ndarray, ...]:
    """Best gain, feature and last lower bucket of every node, among the features it has drawn."""
    nodes = len(rows)
    gain, feature, last = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    whole = weights.sum(axis=1)
    own = (weights ** 2).sum(axis=1) / whole
    for f in picked.T:
        at = node * bins + x[np.arange(len(x)), f[node]]
        lower = np.bincount(at * 2 + y, mass, nodes * bins * 2).reshape(nodes, bins, 2).cumsum(axis=1)[:, :-1]
        count = np.bincount(at, drawn, nodes * bins).reshape(nodes, bins).cumsum(axis=1)[:, :-1]
        upper = weights[:, None] - lower
        ok = (count >= min_leaf) & (rows[:, None] - count >= min_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = ((lower ** 2).sum(axis=2) / lower.sum(axis=2) + (upper ** 2).sum(axis=2) / upper.sum(axis=2)
                     - own[:, None]) / whole[:, None]
        value = np.where(ok, value, -np.inf)
        top = value.argmax(axis=1)
        found = value[np.arange(nodes), top]
        better = found > gain
        gain[better], feature[better], last[better] = found[better], f[better], top[better]
    return gain, feature, last


def grow(x: np.ndarray, y: np.ndarray, drawn: np.ndarray, weight: np.ndarray, depth: int, min_leaf: int, few: int,
         rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree from groups: buckets ``x``, label 0 or 1, how often each is drawn, weight of a row.

    Nodes come level by level; ``lower`` is the child of the buckets up to ``last``, -1 in a leaf, ``upper`` the one after."""
    bins = max(2, int(x.max()) + 1)
    at = np.flatnonzero(drawn > 0)
    node, levels, base = np.zeros(len(at), np.int64), [], 0
    nodes = 1
    for level in range(depth + 1):
        mass, d, side = drawn[at] * weight[at], drawn[at], y[at]
        weights = np.bincount(node * 2 + side, mass, nodes * 2).reshape(nodes, 2)
        rows = np.bincount(node, d, nodes)
        gain, feature, last = np.full(nodes, -1.0), np.full(nodes, -1), np.full(nodes, -1)
        if level < depth:
            picked = np.argsort(rng.random((nodes, x.shape[1])), axis=1)[:, :few]
            begin = np.searchsorted(node, np.arange(nodes + 1))
            for a in range(0, nodes, NODES):
                b = min(a + NODES, nodes)
                cut = slice(begin[a], begin[b])
                found, f, k = _best(x[at[cut]], node[cut] - a, side[cut], d[cut], mass[cut], picked[a:b], weights[a:b],
                                    rows[a:b], bins, min_leaf)
                split = (found > 1e-12) & (weights[a:b].min(axis=1) > 0)
                for to, value in ((gain, found), (feature, f), (last, k)):
                    to[a:b] = np.where(split, value, -1)
        split = feature >= 0
        lower = np.where(split, base + nodes + 2 * (np.cumsum(split) - 1), -1)
        levels.append({"weights": weights, "rows": rows, "gain": gain, "feature": feature, "last": last, "lower": lower})
        base += nodes
        if not split.any():
            break
        go = split[node]
        at, node = at[go], node[go]
        node = lower[node] - base + (x[at, feature[node]] > last[node])
        order = np.argsort(node, kind="stable")
        at, node, nodes = at[order], node[order], 2 * int(split.sum())
    ends = np.cumsum([len(v["rows"]) for v in levels])
    tree = {k: np.concatenate([v[k] for v in levels]) for k in levels[0]}
    tree["prediction"] = tree["weights"].argmax(axis=1)
    # from below: two leaves of one prediction become one
    for end, many in zip(ends[::-1], [len(v["rows"]) for v in levels][::-1]):
        own = np.arange(end - many, end)
        own = own[tree["lower"][own] >= 0]
        low = tree["lower"][own]
        same = (tree["lower"][low] < 0) & (tree["lower"][low + 1] < 0) & (tree["prediction"][low] == tree["prediction"][low + 1])
        tree["lower"][own[same]] = -1
    kept = np.zeros(len(tree["rows"]), bool)
    front = np.zeros(1, np.int64)
    while len(front):
        kept[front] = True
        low = tree["lower"][front]
        front = np.concatenate([low[low >= 0], low[low >= 0] + 1])
    place = np.cumsum(kept) - 1
    tree = {k: v[kept] for k, v in tree.items()}
    tree["lower"] = np.where(tree["lower"] >= 0, place[tree["lower"]], -1)
    for k in ("feature", "last", "gain"):
        tree[k] = np.where(tree["lower"] >= 0, tree[k], -1)
    return tree


def nodes(groups: DataFrame, splits: Sequence[Sequence[float]], trees: int, depth: int, min_leaf: int, seed: int) -> DataFrame:
    """Nodes of all trees from groups ``code, y, weight, n``; ``splits`` are the ends of every feature's buckets."""
    wide, few = len(splits), math.ceil(math.sqrt(len(splits)))
    tasks = min(trees, 2 * groups.sparkSession.sparkContext.defaultParallelism)

    def grown(table: pa.Table) -> pa.Table:
        text = table["code"].combine_chunks().cast(pa.binary()).cast(pa.binary(wide))
        y, n = table["y"].to_numpy(), table["n"].to_numpy()
        weight, task = table["weight"].to_numpy(), table["task"][0].as_py()
        x = np.frombuffer(text.buffers()[1], np.uint8)[text.offset * wide:][:len(text) * wide].reshape(-1, wide)
        # in an order of their own, whichever way they came
        order = np.lexsort((y, np.ascontiguousarray(x).view(f"S{wide}").ravel()))
        x, y, n, weight = x[order] - np.uint8(FIRST), y[order].astype(np.int64), n[order], weight[order]
        out = []
        for tree in range(task, trees, tasks):
            rng = np.random.default_rng((seed, tree))
            t = grow(x, y, rng.poisson(n).astype(float), weight, depth, min_leaf, few, rng)
            inner = t["lower"] >= 0
            share = t["weights"] / np.maximum(t["weights"].sum(axis=1), 1e-300)[:, None]
            # a cut belongs to the left in trees, to the right in buckets
            limit = [math.nextafter(splits[f][k + 1], -math.inf) if i else 0.0
                     for i, f, k in zip(inner.tolist(), t["feature"].tolist(), t["last"].tolist())]
            out.append(pa.table({
                "tree": pa.array(np.full(len(inner), tree), pa.int32()), "id": pa.array(np.arange(len(inner)), pa.int32()),
                "prediction": t["prediction"].astype(float), "impurity": 1 - (share ** 2).sum(axis=1),
                "none": t["weights"][:, 0], "one": t["weights"][:, 1], "rows": t["rows"].astype(np.int64), "gain": t["gain"],
                "lower": pa.array(t["lower"], pa.int32()), "upper": pa.array(np.where(inner, t["lower"] + 1, -1), pa.int32()),
                "feature": pa.array(t["feature"], pa.int32()), "threshold": np.array(limit, float)}))
        return pa.concat_tables(out)

    # few tasks meet in one partition
    return groups.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartition(
        8 * tasks, "task").groupBy("task").applyInArrow(grown, NODE)


def as_model(shell: RandomForestClassificationModel, found: DataFrame) -> RandomForestClassificationModel:
    """``shell`` with these nodes in place of its own: the model is saved, its nodes are written anew, and it is read again."""
    spark = found.sparkSession
    path = work_dir(spark, "forest_model")
    shell.write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    inner = F.col("lower") >= 0
    rows = found.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.array("none", "one").alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
        F.col("lower").alias("leftChild"), F.col("upper").alias("rightChild"), F.struct(
            F.col("feature").alias("featureIndex"),
            F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
