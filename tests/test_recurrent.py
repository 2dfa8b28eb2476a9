"""The recurrent forecast: its gradient, that it learns, that reruns agree."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hourlens.operators import models as md
from hourlens.operators import recurrent as rn
from hourlens.session import work_dir
from hourlens.sources.sinks import write_stage


def test_gradient_matches_differences():
    rng, width, hidden = np.random.default_rng(0), 3, 4
    w = rn.first_weights(width, hidden, 1)
    w = w + 0.1 * rng.normal(size=len(w))
    x, y = rng.normal(size=(5, 6, width)), rng.normal(size=5)
    _, grad = rn.gradient(rn.unpack(w, width, hidden), x, y)
    for k in range(0, len(w), 3):
        step = np.zeros(len(w))
        step[k] = 1e-6
        up, down = (rn.gradient(rn.unpack(w + s, width, hidden), x, y)[0] for s in (step, -step))
        assert (up - down) / 2e-6 == pytest.approx(grad[k], abs=1e-6)


@pytest.fixture(scope="module")
def sequences(spark):
    """A series whose next value is a bent function of the last hours: no line fits it."""
    rng, n, steps = np.random.default_rng(4), 700, 6
    z = rng.uniform(-1, 1, (n + steps, 2))
    rows = []
    for t in range(steps, n + steps):
        past = z[t - steps:t]
        y = 50 + 20 * past[-1, 0] * past[-2, 1] + 10 * abs(past[-3, 0]) + 0.3 * rng.normal()
        rows.append((t, past.ravel().tolist(), float(y)))
    df = spark.createDataFrame(rows, "id long, x array<double>, target double").select(
        "id", "target", array_to_vector("x").alias("lags"))
    df = spark.read.parquet(write_stage(df.repartition(6), work_dir(spark, "sequences")))
    return df.where("id < 560"), df.where("id >= 560")


def mae(df):
    return df.agg(F.avg(F.abs(F.col("prediction") - F.col("target")))).first()[0]


def test_it_beats_the_line_and_reruns_agree(sequences):
    train, test = sequences
    model = rn.fit(train, 2, "id", hidden=16, epochs=40, batches=2, rate=2e-2, decay=0.0)
    got = model.transform(test)
    assert got.columns == ["id", "target", "prediction"] and got.count() == test.count()
    line = md.score_regression(md.fit_forecast(train), test, ["target"])
    mean = train.agg(F.avg("target")).first()[0]
    flat = test.withColumn("prediction", F.lit(mean))
    assert mae(got) < 0.8 * min(mae(line), mae(flat))
    short = [rn.fit(train, 2, "id", hidden=4, epochs=2).weights for _ in range(2)]
    assert np.array_equal(*short)


def test_no_rows(sequences):
    train, test = sequences
    model = rn.fit(train, 2, "id", hidden=2, epochs=1)
    assert model.transform(test.limit(0)).count() == 0
