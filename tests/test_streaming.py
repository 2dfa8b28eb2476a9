"""Stream state: drift that adds up over a feed."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hourlens.operators import drift as dr
from hourlens.streaming import jobs


def rows(spark, values, flags):
    return spark.createDataFrame([(float(v), float(f)) for v, f in zip(values, flags)], "f double, g double")


def psi_of(df):
    return {r["feature"]: round(r["psi"], 9) for r in df.collect()}


def test_epochs_add_up_and_replays_change_nothing(spark):
    rng = np.random.default_rng(3)
    ref = rows(spark, rng.normal(size=400), rng.integers(0, 4, 400))
    parts = [rows(spark, rng.normal(0.4, 1.5, 90), rng.integers(0, 5, 90)) for _ in range(4)]
    state = jobs.DriftState(ref, ["f", "g"], dr.reference_edges(ref, ["f", "g"]))
    seen = []
    for epoch, part in enumerate(parts):
        state.merge(part, epoch)
        state.merge(part, epoch)                # a restart runs the last epoch again
        seen.append(part)
        now = seen[0]
        for p in seen[1:]:
            now = now.unionByName(p)
        both = ref.withColumn("c", F.lit(False)).unionByName(now.withColumn("c", F.lit(True)))
        assert psi_of(state.table()) == psi_of(dr.psi(both, F.col("c"), ["f", "g"]))


def test_a_lost_epoch_is_noticed(spark):
    ref = rows(spark, range(50), range(50))
    state = jobs.DriftState(ref, ["f"], dr.reference_edges(ref, ["f"]))
    state.merge(ref, 0)
    state.merge(ref, 1)
    try:
        state.merge(ref, 4)
    except Exception as e:
        assert "missing" in str(e)
    else:
        raise AssertionError("a gap went unnoticed")


def test_edges_of_few_and_many_values_agree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    ref = rows(spark, rng.normal(size=501).round(1), rng.integers(0, 3, 501))
    few = Counter({r["feature"]: tuple(r["edges"]) for r in dr.reference_edges(ref, ["f", "g"]).collect()})
    monkeypatch.setattr(dr, "FEW", 5)           # f goes by brackets now
    assert few == Counter({r["feature"]: tuple(r["edges"]) for r in dr.reference_edges(ref, ["f", "g"]).collect()})
    want = np.quantile([r["f"] for r in ref.collect()], np.linspace(0, 1, 11))
    assert np.allclose(few["f"], want)
