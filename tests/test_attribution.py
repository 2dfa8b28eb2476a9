"""Shapley attributions against all subsets."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest

from hourlens.operators import attribution as at
from hourlens.operators import models as md

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 4)).round(2)
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, x[:, 2], -2 * x[:, 0]) + 0.1 * rng.normal(size=400)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, d double, y double")
    return md.fit_gbt(df, FEATURES, "y", trees=12, depth=4, subsample=1.0), df, x


def known(paths, row, features):
    """The forest's prediction with only some features known, leaf by leaf."""
    total = 0.0
    for i, v in enumerate(paths["value"]):
        part = v
        for f, low, high, z in zip(*(paths[k][i] for k in ("feature", "low", "high", "share"))):
            if f >= 0:
                part *= float(low < row[f] <= high) if f in features else z
        total += part
    return total


def by_subsets(paths, row):
    out = []
    for j in range(4):
        rest, phi = [k for k in range(4) if k != j], 0.0
        for s in range(4):
            for own in combinations(rest, s):
                w = factorial(s) * factorial(3 - s) / factorial(4)
                phi += w * (known(paths, row, {*own, j}) - known(paths, row, set(own)))
        out.append(phi)
    return out


def test_attributions_match_all_subsets(fitted):
    model, _, x = fitted
    paths = at.leaf_paths(model)
    assert max((p >= 0).sum() for p in paths["feature"]) >= 3
    got = at.attributions(x[:25], paths)
    assert np.allclose(got, [by_subsets(paths, r) for r in x[:25]])


def test_attributions_add_up_for_every_row(fitted):
    model, df, _ = fitted
    rows = at.explain(model, df, FEATURES, ["id"]).toPandas()
    assert len(rows) == 400
    total = rows["base"] + rows["attribution"].map(sum)
    assert np.allclose(total, rows["prediction"], atol=1e-9)
    mean = {r["feature"]: r["mean_abs"] for r in at.mean_attribution(
        at.explain(model, df, FEATURES), FEATURES).collect()}
    want = np.abs(np.stack(rows["attribution"])).mean(axis=0)
    assert np.allclose([mean[f] for f in FEATURES], want) and mean["d"] < mean["c"] < mean["a"]


def test_rows_in_small_chunks(fitted, monkeypatch):
    model, _, x = fitted
    paths = at.leaf_paths(model)
    whole = at.attributions(x, paths)
    monkeypatch.setattr(at, "CHUNK", 1)
    assert np.allclose(at.attributions(x, paths), whole)
    assert at.attributions(x[:0], paths).shape == (0, 4)


def test_rows_of_the_same_buckets_are_explained_once(fitted):
    model, df, _ = fitted
    many = df.unionByName(df)
    once = at.grouped(model, many, FEATURES)
    assert once.count() <= 400 and once.agg({"n": "sum"}).first()[0] == 800
    got = {r["feature"]: r["mean_abs"] for r in at.mean_attribution(at.explain(model, once, FEATURES, ["n"]), FEATURES, "n").collect()}
    want = {r["feature"]: r["mean_abs"] for r in at.mean_attribution(at.explain(model, many, FEATURES), FEATURES).collect()}
    assert got == pytest.approx(want)
