"""A recurrent next-step forecast, trained over all rows of a written table of sequences.

One LSTM layer reads the history, oldest hour first, and a linear unit reads its last state.  Training is
data-parallel: a step is one job in which every task sums loss and gradient over its own rows of the step's batch
(dealt by hash, so an epoch sees every row once), partial sums are added up in a fixed number of tasks, and the
driver moves the weights (Adam) and sends them out again.  What travels is as large as the model.  A lost task is
run again by itself; nothing else is kept between steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlens import config

PARTS = 16          # tasks that add up the gradients of all others
ROWS = 1024         # sequences held at once


def shapes(width: int, hidden: int) -> dict[str, tuple[int, ...]]:
    return {"x": (width, 4 * hidden), "h": (hidden, 4 * hidden), "b": (4 * hidden,), "v": (hidden,), "c": (1,)}


def unpack(flat: np.ndarray, width: int, hidden: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(width, hidden).items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def first_weights(width: int, hidden: int, seed: int) -> np.ndarray:
    rng, parts = np.random.default_rng(seed), []
    for name, shape in shapes(width, hidden).items():
        w = np.zeros(shape)
        if name in "xh":
            w = rng.normal(0, (1 / shape[0]) ** 0.5, shape)
        elif name == "v":
            w = rng.normal(0, 0.1, shape)
        elif name == "b":
            w[hidden:2 * hidden] = 1.0          # remember at first
        parts.append(w.ravel())
    return np.concatenate(parts)


def _squash(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def forward(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, list]:
    """Predictions of sequences (rows, steps, width), and what the way back needs."""
    n, steps, _ = x.shape
    k = len(p["v"])
    h, c, kept = np.zeros((n, k)), np.zeros((n, k)), []
    for t in range(steps):
        z = x[:, t] @ p["x"] + h @ p["h"] + p["b"]
        i, f, o = (_squash(z[:, j * k:(j + 1) * k]) for j in range(3))
        g = np.tanh(z[:, 3 * k:])
        before, c = c, f * c + i * g
        s = np.tanh(c)
        kept.append((h, before, i, f, o, g, s))
        h = o * s
    return h @ p["v"] + p["c"][0], [*kept, h]


def gradient(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of squared errors and its gradient, flat, over some sequences."""
    guess, kept = forward(p, x)
    miss = guess - y
    out = {name: np.zeros_like(w) for name, w in p.items()}
    out["v"] += 2 * kept[-1].T @ miss
    out["c"] += 2 * miss.sum()
    dh, dc = 2 * miss[:, None] * p["v"], 0.0
    for t in range(x.shape[1] - 1, -1, -1):
        h, before, i, f, o, g, s = kept[t]
        dc = dc + dh * o * (1 - s * s)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o),
                             dc * i * (1 - g * g)], axis=1)
        out["x"] += x[:, t].T @ dz
        out["h"] += h.T @ dz
        out["b"] += dz.sum(axis=0)
        dh, dc = dz @ p["h"].T, dc * f
    return float((miss * miss).sum()), np.concatenate([out[name].ravel() for name in p])


@dataclass
class Recurrent:
    """A trained network with the scaling it learned on its training rows."""

    weights: np.ndarray
    width: int
    hidden: int
    mean: np.ndarray
    scale: np.ndarray
    target: tuple[float, float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        guess, _ = forward(unpack(self.weights, self.width, self.hidden), (x - self.mean) / self.scale)
        return guess * self.target[1] + self.target[0]

    def transform(self, df: DataFrame, lags: str = "lags") -> DataFrame:
        """Add ``prediction``."""
        held = df.sparkSession.sparkContext.broadcast(self)
        arrays = df.withColumn("_x", vector_to_array(lags)).drop(lags)
        keep = [c for c in arrays.columns if c != "_x"]

        def run(batches):
            for batch in batches:
                x = _sequences(batch["_x"], held.value.width)
                parts = [held.value.predict(x[a:a + ROWS]) for a in range(0, len(x), ROWS)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch[c] for c in keep], pa.array(np.concatenate(parts) if parts else np.empty(0))],
                    [*keep, "prediction"])

        kinds = "".join(f"`{c}` {t}, " for c, t in arrays.select(*keep).dtypes)
        return arrays.mapInArrow(run, f"{kinds}prediction double")


def _sequences(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1, width) if len(column) else np.empty((0, 1, width))


def _sums(task: int, n: int, loss: float, grad: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([task], pa.int32()), pa.array([n]), pa.array([loss]), pa.array([grad.tobytes()], pa.binary())],
        ["task", "n", "loss", "grad"])


def fit(train: DataFrame, width: int, key: str, label: str = "target", lags: str = "lags", hidden: int = 32,
        epochs: int = 15, batches: int = 4, rate: float = 3e-3, decay: float = 1e-3,
        seed: int = config.SEED) -> Recurrent:
    """Train on ``train``, a written table of flat histories (steps x ``width`` numbers, ``lags``) and targets."""
    spark = train.sparkSession
    rows = train.select(vector_to_array(lags).alias("x"), F.col(label).cast("double").alias("y"),
                        F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(batches)).alias("part"))
    cells = rows.select("x", "y", F.posexplode("x").alias("i", "value"))
    stats = {r["f"]: (r["m"], r["s"]) for r in cells.groupBy((F.col("i") % width).alias("f")).agg(
        F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()}         # one row per feature
    mean = np.array([stats[f][0] for f in range(width)])
    scale = np.array([stats[f][1] or 1.0 for f in range(width)])
    to = rows.agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).first()
    target = float(to["m"]), float(to["s"] or 1.0)
    weights = first_weights(width, hidden, seed)
    slow, square = np.zeros_like(weights), np.zeros_like(weights)
    kind = "task int, n long, loss double, grad binary"

    for step in range(epochs * batches):
        held = spark.sparkContext.broadcast(weights)

        def own(batches_, held=held):
            p, n, loss, total = unpack(held.value, width, hidden), 0, 0.0, np.zeros(len(held.value))
            for batch in batches_:
                x, y = (_sequences(batch["x"], width) - mean) / scale, (batch["y"].to_numpy() - target[0]) / target[1]
                for a in range(0, len(y), ROWS):
                    more, grad = gradient(p, x[a:a + ROWS], y[a:a + ROWS])
                    n, loss, total = n + len(y[a:a + ROWS]), loss + more, total + grad
            if n:
                yield _sums(TaskContext.get().partitionId(), n, loss, total)

        def add(batches_):
            n, loss, total = 0, 0.0, None
            for batch in batches_:
                for m, more, grad in zip(*(batch[c].to_pylist() for c in ("n", "loss", "grad"))):
                    grad = np.frombuffer(grad)
                    n, loss, total = n + m, loss + more, grad if total is None else total + grad
            if n:
                yield _sums(TaskContext.get().partitionId(), n, loss, total)

        parts = rows.where(F.col("part") == step % batches).select("x", "y").mapInArrow(own, kind)
        # summed in order of tasks, so that reruns agree; at most PARTS gradients come back
        found = parts.repartition(PARTS, "task").sortWithinPartitions("task").mapInArrow(add, kind).collect()
        held.destroy()
        if not found:
            continue
        n = sum(r["n"] for r in found)
        grad = sum(np.frombuffer(r["grad"]) for r in found) / n + decay * weights
        slow, square = 0.9 * slow + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        weights = weights - rate * (slow / (1 - 0.9 ** (step + 1))) / (
            np.sqrt(square / (1 - 0.999 ** (step + 1))) + 1e-8)
    return Recurrent(weights, width, hidden, mean, scale, target)
