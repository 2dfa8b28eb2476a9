"""Euclidean silhouettes from cells against all pairs."""

import numpy as np
import pytest

from hourlens.operators import silhouettes as sil


def all_pairs(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    kinds, out = sorted(set(label)), []
    for i, own in enumerate(label):
        sums = {k: (d[i, label == k].sum(), (label == k).sum()) for k in kinds}
        s, n = sums.pop(own)
        if n == 1 or not sums:
            out.append(0.0)
            continue
        a, b = s / (n - 1), min(t / m for t, m in sums.values())
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.array(out)


def frame(spark, x, label):
    return spark.createDataFrame([(int(c), *map(float, r)) for c, r in zip(label, x)],
                                 "label int, " + ", ".join(f"f{i} double" for i in range(x.shape[1])))


@pytest.mark.parametrize("d,shape", [(1, "spread"), (2, "groups"), (3, "copies"), (5, "spread")])
def test_mean_silhouette(spark, monkeypatch, d, shape):
    monkeypatch.setattr(sil, "LEAF", 8)         # more cells at this size
    monkeypatch.setattr(sil, "BLOCK", 40)
    rng = np.random.default_rng(d)
    n = 700
    label = rng.integers(0, 3, n)
    x = rng.normal(size=(n, d)) * rng.choice([1.0, 30.0], d) + label[:, None] * 0.7
    if shape == "groups":
        x += 1000.0 * (label[:, None] == 2)
    if shape == "copies":
        x[: n // 2] = x[rng.integers(0, 5, n // 2)].round(1)
        label[-1] = 9                           # alone in its cluster
    df = frame(spark, x, label)
    got = sil.mean_distance_silhouette(df, [f"f{i}" for i in range(d)], "label").first()
    want = all_pairs(x, label)
    assert got["n"] == n and got["silhouette"] == pytest.approx(want.mean(), abs=2e-5)
    each = sil.mean_distance_points(df, [f"f{i}" for i in range(d)], "label").toPandas()
    assert each["w"].sum() == n
    spread = np.repeat(each["silhouette"], each["w"].astype(int)).to_numpy()
    assert np.abs(np.sort(spread) - np.sort(want)).max() < 0.0026 and np.abs(np.sort(spread) - np.sort(want)).mean() < 1e-4


def test_cells_of_the_last_level_hold_crowds(spark, monkeypatch):
    monkeypatch.setattr(sil, "LEVELS", 3)
    monkeypatch.setattr(sil, "LEAF", 4)
    monkeypatch.setattr(sil, "BLOCK", 16)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.random((300, 2)) * 0.01, [[1.0, 1.0]]])
    label = np.append(rng.integers(0, 2, 300), 1)
    got = sil.mean_distance_points(frame(spark, x, label), ["f0", "f1"], "label").toPandas()
    assert got["w"].sum() == 301 and got["silhouette"].between(-1, 1).all()


def test_few_rows(spark):
    one = frame(spark, np.array([[1.0], [2.0]]), [0, 0])
    assert tuple(sil.mean_distance_silhouette(one, ["f0"], "label").first()) == (0.0, 2)
    same = frame(spark, np.ones((4, 1)), [0, 0, 1, 1])
    assert tuple(sil.mean_distance_silhouette(same, ["f0"], "label").first()) == (0.0, 4)
    none = sil.mean_distance_silhouette(one.limit(0), ["f0"], "label").first()
    assert (none["silhouette"], none["n"]) == (None, 0)


def test_nothing_that_grows_is_broadcast(spark):
    rng = np.random.default_rng(3)
    x = rng.random((900, 2))
    out = sil.mean_distance_points(frame(spark, x, rng.integers(0, 2, 900)), ["f0", "f1"], "label")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_written_rows_stay_near_the_number_of_points(spark, monkeypatch):
    written, rows = sil._written, {}

    def counted(df, base, name):
        out = written(df, base, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(sil, "_written", counted)
    rng = np.random.default_rng(12)
    x = rng.random((4000, 3))
    label = rng.integers(0, 2, 4000)
    got = sil.mean_distance_silhouette(frame(spark, x, label), ["f0", "f1", "f2"], "label").first()
    assert got["silhouette"] == pytest.approx(all_pairs(x, label).mean(), abs=2e-5)
    assert sum(rows.values()) < 3 * 4000        # points twice and outlines, no list of cells by target


def test_chunk_boxes_part_where_the_order_leaps():
    x = np.concatenate([np.random.default_rng(1).random((900, 2)) * 0.1, [[0.9, 0.9], [1.0, 1.0]]])
    low, high = sil._boxes(x, 8)
    assert len(low) == 8 and (high - low).max() < 0.2
    assert all(((p >= low) & (p <= high)).all(axis=1).any() for p in x)
