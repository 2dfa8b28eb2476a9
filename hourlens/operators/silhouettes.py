"""Silhouette under plain Euclidean distance, for any number of rows.

The mean distance from a row to a cluster has no closed form, and all pairs are out of the question.  Distances
are summed over cells instead, as gravity is:

1. Equal points of a cluster are counted into one and dealt along a space-filling order into chunks of about ``CHUNK``.
2. A chunk halves its points of each cluster into a tree of cells, down to ``LEAF`` points.  A cell knows its rows, their
   centre, the scatter around it and how far its rows lie from it.
3. Every chunk tells every other one the coarsest cells that are exact enough for all of its places: single points next
   to it, a few cells far away.  Only these are shuffled, no list of cells by target is ever written.
4. A chunk halves its own points and what it was told into trees again, deals its places into blocks of at most
   ``BLOCK``, and every block walks down the trees in memory: cells that are exact enough are summed by centre and
   scatter (second order), others are replaced by their halves, the smallest by their points.

Error: the third derivative of |x| along a line is at most 2 / (sqrt(3) |x|^2), so a cell of radius r whose rows have the
mean cubed distance t from its centre is off by no more than t / (3 sqrt(3) (D - r)^2) a row at distance D.  A cell is summed
where that is at most ``EXACT`` times the greater of D and a lower bound of the block's mean distance to the cluster.
Neither exceeds the mean distance, so every mean distance is exact to 2 ``EXACT`` = 0.13 % and a silhouette to 0.26 %;
offsets on both sides of the centres cancel, so what is measured is some hundred times less.

A row alone in its cluster, and rows of a single cluster, have silhouette 0; rows with a null feature are an error.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.session import work_dir

LEVELS, LEAF, BLOCK, EXACT = 12, 16, 256, 0.00065
CHUNK = 50_000      # points of a chunk
BOXES = 16          # boxes that a chunk's places are told by
HEADS = 4096        # cells that mean distances are bounded by, about
TILE = 1024         # sources held at once
PAIRS = 50_000      # blocks by cells held at once


def _written(df: DataFrame, base: str, name: str) -> DataFrame:
    df.write.parquet(f"{base}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")


def _unit_points(df: DataFrame, features: Sequence[str], label: str, names: Sequence[str]) -> DataFrame:
    """Distinct points ``label, <names in 0..1>, w``; silhouettes do not depend on scale."""
    box = fc.fitted(df.agg(
        *[F.min(F.col(f).cast("double")).alias(f"lo{i}") for i, f in enumerate(features)],
        F.greatest(*[F.max(F.col(f).cast("double")) - F.min(F.col(f).cast("double")) for f in features],
                   F.lit(0.0)).alias("side")))
    side = F.when(box["side"] > 0, box["side"]).otherwise(F.lit(1.0))
    cells = [F.when(F.col(f).isNull(), F.raise_error(F.lit(f"null in clustering feature {f}")).cast("double"))
             .otherwise((F.col(f).cast("double") - box[f"lo{i}"]) / side).alias(n)
             for i, (f, n) in enumerate(zip(features, names))]
    return df.select(F.col(label).alias("label"), *cells).groupBy("label", *names).agg(
        F.count("*").cast("double").alias("w"))


def _place(names: Sequence[str], depth: int) -> Column:
    """Place along a space-filling order: the bits of all coordinates in turn."""
    def part(i: int, n: str) -> Column:
        spot = F.least(F.floor(F.col(n) * (1 << depth)), F.lit((1 << depth) - 1)).cast("long")
        return reduce(lambda a, b: a + b, [
            F.shiftleft(F.shiftright(spot, b).bitwiseAND(F.lit(1).cast("long")), b * len(names) + i) for b in range(depth)])
    return reduce(lambda a, b: a + b, [part(i, n) for i, n in enumerate(names)])


def _pairs(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


class Tree:
    """Sources halved at the middle of their widest feature, each label apart, down to ``leaf`` sources.

    A source is a point or a cell: label, rows ``n``, centre ``c``, ``scatter`` (summed over its rows) and radius ``r``."""

    def __init__(self, label: np.ndarray, n: np.ndarray, c: np.ndarray, scatter: np.ndarray, r: np.ndarray, leaf: int):
        self.source = label, n, c, scatter, r
        pairs, parts, leaves, base, seen = _pairs(c.shape[1]), [], [np.empty(0, np.int64)], 0, 0
        order = np.argsort(label, kind="stable")
        start = np.flatnonzero(np.diff(label[order], prepend=-1))
        self.roots = np.arange(len(start))
        while len(start):
            many = np.diff(np.append(start, len(order)))
            of, x, w = np.repeat(np.arange(len(start)), many), c[order], n[order]
            rows = np.add.reduceat(w, start)
            centre = np.add.reduceat(w[:, None] * x, start) / rows[:, None]
            off = x - centre[of]
            spread = np.add.reduceat(scatter[order] + np.column_stack([w * off[:, i] * off[:, j] for i, j in pairs]), start)
            away = np.sqrt((off * off).sum(axis=1)) + r[order]
            low, high = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start)
            split = many > leaf
            # halves come right after this level; a leaf's sources are a run of ``self.leaves``
            child = np.where(split, base + len(start) + 2 * (np.cumsum(split) - 1), -1)
            held = np.where(split, 0, many)
            parts.append((label[order[start]], rows, centre, spread, np.maximum.reduceat(away, start),
                          np.add.reduceat(w * away ** 3, start) / rows, child, seen + np.cumsum(held) - held, held, low, high))
            leaves.append(order[~split[of]])
            seen, base, go = seen + held.sum(), base + len(start), split[of]
            along = x[np.arange(len(x)), np.argmax(high - low, axis=1)[of]]
            order = order[go][np.lexsort((along[go], of[go]))]
            half = np.column_stack([many[split] // 2, many[split] - many[split] // 2]).ravel()
            start = np.cumsum(half) - half
        self.leaves = np.concatenate(leaves)
        if parts:
            (self.label, self.n, self.c, self.scatter, self.r, self.cubed, self.child, self.at, self.many, self.low,
             self.high) = map(np.concatenate, zip(*parts))

    def down(self, levels: int) -> np.ndarray:
        """The cells so many levels down, or the leaves above."""
        at = self.roots
        for _ in range(levels):
            deep = self.child[at] >= 0
            at = np.concatenate([at[~deep], self.child[at[deep]], self.child[at[deep]] + 1])
        return at

    def walk(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """What every target needs: (target, cell) pairs to sum and (target, source) pairs of the leaves too near.

        Targets are boxes ``low, high`` (targets, boxes, features); ``least`` (targets, labels) bounds mean distances."""
        target = np.repeat(np.arange(len(low)), len(self.roots))
        cell = np.tile(self.roots, len(low))
        far, near = [], []
        while len(cell):
            ok = np.empty(len(cell), bool)
            for a in range(0, len(cell), PAIRS):
                t, k = target[a:a + PAIRS], cell[a:a + PAIRS]
                gap = _gap(low[t], high[t], self.c[k])
                bound = EXACT * np.maximum(gap, least[t, self.label[k]]) * (gap - self.r[k]) ** 2
                ok[a:a + PAIRS] = (gap > 2 * self.r[k]) & (self.cubed[k] / (3 * 3 ** 0.5) <= bound)
            far.append((target[ok], cell[ok]))
            target, cell = target[~ok], cell[~ok]
            leaf = self.child[cell] < 0
            near.append((target[leaf], cell[leaf]))
            target, half = np.repeat(target[~leaf], 2), self.child[cell[~leaf]]
            cell = np.column_stack([half, half + 1]).ravel()
        target, cell = (np.concatenate(v) for v in zip(*far)) if far else (target, cell)
        to, leaf = (np.concatenate(v) for v in zip(*near)) if near else (target, cell)
        held = self.many[leaf] if len(leaf) else leaf
        run = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        return target, cell, np.repeat(to, held), self.leaves[np.repeat(self.at[leaf], held) + run] if len(leaf) else leaf


def _gap(low: np.ndarray, high: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distance of places ``c`` (n, d) from the nearest of their boxes (n, boxes, d)."""
    c = c[:, None]
    return np.sqrt((np.maximum(np.maximum(low - c, c - high), 0) ** 2).sum(axis=2).min(axis=1))


def _boxes(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes ``low, high`` around places: the longest is cut in the middle, since a stretch of the order leaps."""
    parts = [x]
    while len(parts) < most:
        sides = [p.max(axis=0) - p.min(axis=0) for p in parts]
        k = int(np.argmax([v.max() for v in sides]))
        i = int(np.argmax(sides[k]))
        upper = parts[k][:, i] > parts[k][:, i].min() + sides[k][i] / 2
        if upper.all() or not upper.any():
            break
        parts[k:k + 1] = [parts[k][~upper], parts[k][upper]]
    return np.array([p.min(axis=0) for p in parts]), np.array([p.max(axis=0) for p in parts])


def _least(low: np.ndarray, high: np.ndarray, heads: tuple[np.ndarray, ...], many: np.ndarray) -> np.ndarray:
    """Lower bound of the mean distance from any place of each target to each label: that to the cells' centres."""
    label, n, c = heads
    out = np.zeros((len(low), len(many)))
    for i in range(len(low)):
        away = _gap(low[i][None], high[i][None], c)
        out[i] = np.bincount(label, n * away, len(many)) / many
    return out


def _add_points(x: np.ndarray, label: np.ndarray, n: np.ndarray, c: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` (targets by labels) the distances to the rows of every point."""
    for k in np.unique(label):
        own = np.flatnonzero(label == k)
        for a in range(0, len(own), TILE):
            at = own[a:a + TILE]
            square = sum((x[:, i, None] - c[at, i]) ** 2 for i in range(x.shape[1]))
            total[:, k] += np.sqrt(square) @ n[at]


def _add_cells(x: np.ndarray, label: np.ndarray, n: np.ndarray, c: np.ndarray, scatter: np.ndarray, total: np.ndarray) -> None:
    """The same for cells, by centre and scatter.  Cells are far from all of ``x``."""
    d = x.shape[1]
    middle = x.mean(axis=0)
    x, c = x - middle, c - middle
    own_square = (x * x).sum(axis=1)
    powers = np.column_stack([*[x[:, i] * x[:, j] for i, j in _pairs(d)], x, np.ones(len(x))])
    full = np.zeros((len(c), d, d))
    for k, (i, j) in enumerate(_pairs(d)):
        full[:, i, j] = full[:, j, i] = scatter[:, k]
    turned = np.einsum("nij,nj->ni", full, c)
    # (x - c)' S (x - c) as a polynomial in x
    bend = np.column_stack([*[(1 if i == j else 2) * full[:, i, j] for i, j in _pairs(d)], -2 * turned,
                            (turned * c).sum(axis=1)])
    trace, square = np.einsum("nii->n", full), (c * c).sum(axis=1)
    for k in np.unique(label):
        own = np.flatnonzero(label == k)
        for a in range(0, len(own), TILE):
            at = own[a:a + TILE]
            apart = x @ (-2 * c[at].T)
            apart += square[at]
            apart += own_square[:, None]
            away = np.sqrt(apart)
            total[:, k] += away @ n[at]
            part = powers @ bend[at].T
            part /= apart
            np.subtract(trace[at], part, out=part)
            part /= away
            total[:, k] += 0.5 * part.sum(axis=1)


def mean_distance_points(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Silhouette of every distinct point: ``label, w`` (rows at the point) and ``silhouette``."""
    spark, d = df.sparkSession, len(features)
    names, pairs = [f"x{i}" for i in range(d)], _pairs(d)
    base = work_dir(spark, "silhouette")
    points = _written(_unit_points(df, features, label, names), base, "points")
    found = points.count()
    chunks = max(1, min(math.ceil(found / (8 * BLOCK)),
                        max(2 * spark.sparkContext.defaultParallelism, math.ceil(found / CHUNK))))
    dealt = _written(points.repartitionByRange(chunks, _place(names, min(LEVELS, 60 // d)), *names).withColumn(
        "chunk", F.spark_partition_id()), base, "dealt")
    sizes = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.sum("w").alias("n")).collect()}   # one row per cluster
    order = {v: i for i, v in enumerate(sizes)}
    many = np.array(list(sizes.values()))
    parts = 4 * chunks              # few chunks meet in one task
    by_chunk = dealt.repartition(parts, "chunk")
    held = dealt.groupBy("chunk").agg(F.count("*").alias("held")).repartition(parts, "chunk")
    levels = max(0, int(math.log2(max(1, HEADS / (chunks * max(1, len(many)))))))

    def places(own: pa.Table) -> tuple[np.ndarray, ...]:
        return (np.array([order[v] for v in own["label"].to_pylist()], np.int64), own["w"].to_numpy(),
                np.column_stack([own[n].to_numpy() for n in names]))

    def tree_of(where: np.ndarray, n: np.ndarray, x: np.ndarray, leaf: int) -> Tree:
        return Tree(where, n, x, np.zeros((len(x), len(pairs))), np.zeros(len(x)), leaf)

    def blocks_of(x: np.ndarray, most: int) -> Tree:
        return tree_of(np.zeros(len(x), np.int64), np.ones(len(x)), x, most)

    def outline(own: pa.Table) -> pa.Table:
        """A chunk's boxes, and the cells that mean distances are bounded by."""
        where, n, x = places(own)
        tree, (low, high) = tree_of(where, n, x, LEAF), _boxes(x, BOXES)
        head = tree.down(levels)
        return pa.table({
            "chunk": pa.array([own["chunk"][0].as_py()] * (len(low) + len(head)), pa.int32()),
            "label": pa.array([-1] * len(low) + tree.label[head].tolist(), pa.int32()),
            "n": np.concatenate([np.zeros(len(low)), tree.n[head]]),
            "low": pa.array([*low.tolist(), *tree.c[head].tolist()], pa.list_(pa.float64())),
            "high": pa.array([*high.tolist(), *tree.c[head].tolist()], pa.list_(pa.float64()))})

    outlines = _written(by_chunk.groupBy("chunk").applyInArrow(
        outline, "chunk int, label int, n double, low array<double>, high array<double>"), base, "outlines")
    rows = outlines.collect()       # per chunk, its boxes and at most ``HEADS`` / chunks cells or one a label
    low = np.full((chunks, BOXES, d), np.inf)
    high = np.full((chunks, BOXES, d), np.inf)
    filled = np.zeros(chunks, np.int64)
    for r in rows:
        if r["label"] < 0:
            low[r["chunk"], filled[r["chunk"]]], high[r["chunk"], filled[r["chunk"]]] = r["low"], r["high"]
            filled[r["chunk"]] += 1
    heads = (np.array([r["label"] for r in rows if r["label"] >= 0], np.int64),
             np.array([r["n"] for r in rows if r["label"] >= 0]),
             np.array([r["low"] for r in rows if r["label"] >= 0]).reshape(-1, d))
    least = _least(low, high, heads, many) if rows else np.zeros((chunks, 0))
    cell = [f"c{i}" for i in range(d)] + [f"s{i}_{j}" for i, j in pairs]

    def tell(own: pa.Table) -> pa.Table:
        """What the other chunks need to know of a chunk."""
        where, n, x = places(own)
        tree = tree_of(where, n, x, LEAF)
        others = np.flatnonzero((np.arange(chunks) != own["chunk"][0].as_py()) & (filled > 0))
        to, cells, near, at = tree.walk(low[others], high[others], least[others])
        told = np.column_stack([np.concatenate([tree.c[cells], x[at]]),
                                np.concatenate([tree.scatter[cells], np.zeros((len(at), len(pairs)))])])
        return pa.table({"chunk": pa.array(others[np.concatenate([to, near])], pa.int32()),
                         "label": pa.array(np.concatenate([tree.label[cells], where[at]]), pa.int32()),
                         "n": np.concatenate([tree.n[cells], n[at]]),
                         "r": np.concatenate([tree.r[cells], np.zeros(len(at))]),
                         **{k: told[:, i] for i, k in enumerate(cell)}})

    told = by_chunk.groupBy("chunk").applyInArrow(
        tell, "chunk int, label int, n double, r double, " + ", ".join(f"{k} double" for k in cell))

    def score(own: pa.Table, met: pa.Table) -> pa.Table:
        where, n, x = places(own)
        if own["held"].to_pylist()[:1] not in ([], [len(x)]):
            raise ValueError("points of a chunk are missing")       # every sum over its cells would lack them
        total = np.zeros((len(x), len(many)))
        got = np.column_stack([met[k].to_numpy() for k in cell]) if len(met) else np.empty((0, len(cell)))
        tree = Tree(np.concatenate([where, met["label"].to_numpy().astype(np.int64)]),
                    np.concatenate([n, met["n"].to_numpy()]), np.concatenate([x, got[:, :d]]),
                    np.concatenate([np.zeros((len(x), len(pairs))), got[:, d:]]),
                    np.concatenate([np.zeros(len(x)), met["r"].to_numpy()]), LEAF)
        blocks = blocks_of(x, BLOCK)
        all_blocks = np.flatnonzero(blocks.child < 0) if len(x) else np.empty(0, np.int64)
        s_label, s_n, s_c, s_scatter, s_r = tree.source
        for a in range(0, len(all_blocks), 16):
            some = all_blocks[a:a + 16]
            lo, hi = blocks.low[some][:, None], blocks.high[some][:, None]
            to, cells, near, at = tree.walk(lo, hi, _least(lo, hi, heads, many))
            for b, block in enumerate(some):
                mine = blocks.leaves[blocks.at[block]:blocks.at[block] + blocks.many[block]]
                summed, own_total = cells[to == b], np.zeros((len(mine), len(many)))
                source = at[near == b]
                wide = s_r[source] > 0      # a told cell is exact enough for all of the chunk
                point, source = source[~wide], source[wide]
                _add_cells(x[mine], np.concatenate([tree.label[summed], s_label[source]]),
                           np.concatenate([tree.n[summed], s_n[source]]), np.concatenate([tree.c[summed], s_c[source]]),
                           np.concatenate([tree.scatter[summed], s_scatter[source]]), own_total)
                _add_points(x[mine], s_label[point], s_n[point], s_c[point], own_total)
                total[mine] = own_total
        at = np.arange(len(x))
        alone = many[where] < 2
        a = total[at, where] / np.where(alone, 1, many[where] - 1)
        others = total / many
        others[at, where] = np.inf
        b = others.min(axis=1, initial=np.inf)
        top = np.maximum(a, b)
        value = np.where(alone | ~np.isfinite(b) | (top <= 0), 0.0, (b - a) / np.where(top > 0, top, 1))
        return pa.table({"label": own["label"], "w": own["w"], "silhouette": np.nan_to_num(value)})

    kind_of = dict(points.dtypes)["label"]
    whole = by_chunk.hint("merge").join(held, "chunk")      # chunks grow in number: no side is broadcast
    return whole.groupBy("chunk").cogroup(told.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(
        score, f"label {kind_of}, w double, silhouette double")


def mean_distance_silhouette(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row: the mean silhouette of all rows and their number."""
    scored = mean_distance_points(df, features, label)
    return scored.agg(fc.ratio(F.sum(F.col("w") * F.col("silhouette")), F.sum("w")).alias("silhouette"),
                      F.coalesce(F.sum("w"), F.lit(0.0)).cast("long").alias("n"))
