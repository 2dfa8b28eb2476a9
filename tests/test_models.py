"""Fits on data with a known signal: better than the baseline, saved, repeatable."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hourlens.operators import clustering as cu
from hourlens.operators import evaluation as ev
from hourlens.operators import models as md
from hourlens.plans import learning
from hourlens.session import work_dir

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(600, 3)), columns=X)
    pdf["y"] = 3 * pdf["a"] - 2 * (pdf["b"] > 0) + rng.normal(0, 0.1, 600)
    pdf["risk"] = (pdf["a"] + pdf["b"] > 1).astype(int)
    pdf["id"] = range(600)
    return spark.createDataFrame(pdf).persist()


def test_regressors_beat_the_mean(data):
    for fit in (md.fit_linear, lambda *a: md.fit_gbt(*a, trees=10)):
        out = md.score_regression(fit(data, X, "y"), data, ["y"])
        assert ev.regression_metrics(out, "y").first()["r2"] > 0.8


def test_classifiers_beat_the_majority(spark, data):
    for fit in (md.fit_logistic, lambda *a: md.fit_forest(*a, trees=10, depth=5)):
        out = md.score_risk(fit(data, X, "risk"), data, ["risk"])
        assert out.count() == 600 and "PROXY" in out.first()["note"]
        assert ev.roc_auc(out, "risk", "score").first()["roc_auc"] > 0.9


def test_saved_model_scores_the_same(spark, data):
    model, path = md.fit_linear(data, X, "y"), work_dir(spark, "model")
    model.write().overwrite().save(path)
    both = md.score_regression(model, data, ["id"]).join(
        md.score_regression(PipelineModel.load(path), data, ["id"])
        .withColumnRenamed("prediction", "again"), "id")
    assert both.where(F.abs(F.col("prediction") - F.col("again")) > 1e-9).count() == 0


def test_permutation_finds_the_signal(data):
    model = md.fit_gbt(data, X, "y", trees=10)
    imp = {r["feature"]: r["importance"] for r in md.permutation_importance(
        model, data, X, "y", "id", bucket_rows=300).collect()}
    assert set(imp) == set(X) and imp["a"] > imp["b"] > abs(imp["c"])


def test_missing_feature_is_named(data):
    with pytest.raises(KeyError, match="zz"):
        md.fit_linear(data, ["a", "zz"], "y")


def test_select_k_finds_separated_groups(spark):
    rng = np.random.default_rng(2)
    pts = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame(pd.DataFrame({"id": range(120), "p": pts[:, 0], "q": pts[:, 1]}))
    table, models = cu.select_k(df, ["p", "q"], ks=(2, 3, 4), restarts=2)
    assert table.where("is_best").first()["k"] == 3 and set(models) == {2, 3, 4}


def test_forecast_learns_a_daily_cycle(spark):
    from hourlens.operators import windows as win

    rows = [(datetime(2024, 1, 1) + timedelta(hours=h), float(h % 24)) for h in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, measure double")
    seq = win.chrono_split(md.lag_features(
        win.history(df, "ts", ["measure"], "measure"), ["measure"]), "ts").persist()
    model = md.fit_forecast(seq.where("is_train"))
    out = md.score_regression(model, seq.where("not is_train"), ["target"])
    assert ev.regression_metrics(out, "target").first()["mae"] < 0.5


def _lloyd(x, centres, tol=1e-4):
    """One model at a time, from the same start."""
    for _ in range(300):
        own = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[own == k].mean(0) if (own == k).any() else c for k, c in enumerate(centres)])
        if ((new - centres) ** 2).sum() <= tol * x.var(axis=0).mean():
            break
        centres = new
    own = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
    return own, ((x - centres[own]) ** 2).sum()


def test_many_models_fit_like_single_ones(spark):
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 0.6, (150, 3)) for c in (-3, 0, 1, 4)])
    data = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(5)
    begun = cu.starts(data, [2, 3, 4, 6], 3, 1)
    assert len(begun) == 12 and begun[3, 0].shape == (3, 3) and (begun[3, 0] != begun[3, 1]).any()
    fitted = cu.fit_many(data, begun)
    vec = data.select("x", array_to_vector("x").alias("features"))
    for m, start in begun.items():
        own, cost = _lloyd(x, start)
        assert fitted[m].cost == pytest.approx(cost)
        got = {tuple(r["x"]): r["cluster"] for r in fitted[m].transform(vec).collect()}
        assert [got[tuple(r)] for r in x.tolist()] == own.tolist()
    one = cu.fit_many(data, {(4, 1): begun[4, 1]})[4, 1]
    assert np.allclose(one.centres, fitted[4, 1].centres)
    best = cu.kmeans(vec, 4, restarts=3, seed=1)
    assert best.cost == pytest.approx(min(fitted[4, r].cost for r in range(3)))


def test_clusters_of_equal_rows(spark):
    data = spark.createDataFrame([([1.0, 2.0],)] * 9, "x array<double>")
    model = cu.fit_many(data, cu.starts(data, [3], 1, 5))[3, 0]
    assert model.cost == 0 and set(map(tuple, model.centres)) == {(1.0, 2.0)}


def test_classifiers_deal_training_rows_evenly(spark, data, monkeypatch):
    monkeypatch.setattr(md, "ROWS", 50)
    one = data.coalesce(1)
    assert one.rdd.getNumPartitions() == 1
    sizes = md.dealt(one).rdd.glom().map(len).collect()
    assert len(sizes) == 12 and max(sizes) <= 100 and sum(sizes) == 600
    log = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("dealt", "")
    md.fit_logistic(one, X, "risk", max_iter=3)
    stages = [log.getStageInfo(i) for j in log.getJobIdsForGroup("dealt") for i in log.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("", "")
    assert max(s.numTasks for s in stages if s and "treeAggregate" in s.name) == 12


def test_feature_stage_has_tasks_by_rows(spark, monkeypatch, tmp_path):
    spark.range(1200).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("ts"),
        F.lit(1).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 100).cast("double").alias("value"),
        F.lit('{"k": 7}').alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(md, "ROWS", 50)
    stage = learning._features(spark, str(tmp_path))
    sizes = [r["count"] for r in stage.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1200 and len(sizes) == 24 and max(sizes) <= 100


def test_boosting_counts_rows_of_the_same_buckets(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor

    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3)).round(1)
    rows = [(*map(float, r), float(2 * r[0] + r[1] ** 2 + e)) for r, e in zip(x, rng.normal(0, 0.3, 500))] * 3
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    seen = []
    monkeypatch.setattr(md, "dealt", lambda d: seen.append(d.count()) or d)
    model = md.fit_gbt(df, X, "y", trees=8, subsample=1.0)
    assert len(seen) == 1 and seen[0] <= 500
    md.ensure_checkpoint(spark)
    plain = Pipeline(stages=[md.assemble(X), GBTRegressor(labelCol="y", maxIter=8, maxDepth=5, seed=7)]).fit(df)
    both = zip(model.transform(df).collect(), plain.transform(df).collect())
    assert max(abs(a["prediction"] - b["prediction"]) for a, b in both) < 1e-9


def test_clusters_count_equal_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(60, 2)), rng.integers(1, 9, 60), axis=0)
    each = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    begun = cu.starts(each, [2, 4], 2, 3)
    counted = each.groupBy("x").agg(F.count("*").alias("w"))
    a, b = cu.fit_many(each, begun), cu.fit_many(counted, begun)
    assert all(np.allclose(a[m].centres, b[m].centres) and a[m].cost == pytest.approx(b[m].cost) for m in begun)
    sizes, fit = [], cu.fit_many
    monkeypatch.setattr(cu, "fit_many", lambda d, *args: sizes.append(d.count()) or fit(d, *args))
    cu.kmeans(each.select(array_to_vector("x").alias("features")), 2, restarts=1)
    assert sizes == [60]


def test_forest_counts_every_row_of_a_group(spark, tmp_path):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 4, 3000), rng.integers(0, 50, 3000)
    y = (rng.random(3000) < np.where(b < 20, 0.1, 0.8) * (a > 0)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": a.astype(float), "b": b.astype(float), "y": y}))
    model = md.fit_forest(df, ["a", "b"], "y", trees=30, depth=6)
    forest = model.stages[-1]
    assert isinstance(forest, RandomForestClassificationModel) and forest.getNumTrees == 30 and forest.getMaxDepth() == 6
    # all 3,000 rows are drawn from, once on average, and no leaf has fewer than five
    nodes = forest.write().overwrite().save(str(tmp_path / "m")) or spark.read.parquet(str(tmp_path / "m" / "data"))
    roots = [r["n"] for r in nodes.where("nodeData.id = 0").select(F.col("nodeData.rawCount").alias("n")).collect()]
    assert len(set(roots)) > 1 and abs(np.mean(roots) - 3000) < 60
    assert nodes.agg(F.min("nodeData.rawCount")).first()[0] >= 5
    ours = md.score_risk(model, df, ["y"])
    was = md.score_risk(Pipeline(stages=[md.assemble(["a", "b"]), RandomForestClassifier(
        labelCol="y", weightCol="weight", numTrees=30, maxDepth=6, minInstancesPerNode=5, seed=1)]).fit(
        md.with_class_weight(df, "y")), df, ["y"])
    one, two = (ev.roc_auc(s, "y", "score").first()["roc_auc"] for s in (ours, was))
    assert one == pytest.approx(two, abs=0.01)
    mean = [s.agg(F.avg("score")).first()[0] for s in (ours, was)]
    assert mean[0] == pytest.approx(mean[1], abs=0.02)


def test_forest_keeps_nothing_by_row_and_tree(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("rows by trees")

    monkeypatch.setattr(md, "dealt", refused)
    df = spark.range(2000).selectExpr("cast(id % 10 as double) a", "cast(id % 7 as double) b", "cast(id % 10 > 6 as int) y")
    out = md.score_risk(md.fit_forest(df, ["a", "b"], "y", trees=5, depth=4), df, ["y"])
    assert out.where("label <> y").count() == 0 and out.count() == 2000


def test_forest_of_many_groups_is_fitted_row_by_row(spark, data, monkeypatch):
    monkeypatch.setattr(md, "GROUPS", 10)
    out = md.score_risk(md.fit_forest(data, X, "risk", trees=10, depth=5), data, ["risk"])
    assert ev.roc_auc(out, "risk", "score").first()["roc_auc"] > 0.9


def test_forest_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 1), (2.0, 1)], "a double, y int")
    with pytest.raises(Exception, match="null in feature"):
        md.fit_forest(df, ["a"], "y", trees=2, depth=2)
