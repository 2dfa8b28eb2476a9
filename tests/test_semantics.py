"""Small literal tables for the places where engines and libraries differ."""

import math
from bisect import bisect_right
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions import quantiles as qt
from hourlens.functions.ranks import average_ranks
from hourlens.operators import aggregates as ag
from hourlens.operators import cleaning as cl
from hourlens.operators import clustering as cu
from hourlens.operators import drift as dr
from hourlens.operators import evaluation as ev
from hourlens.operators import features as fx
from hourlens.operators import recommend as rc
from hourlens.operators import relational as rel
from hourlens.operators import rules as ru
from hourlens.operators import stats as sx
from hourlens.operators import windows as win
from hourlens.session import work_dir
from hourlens.sources import readers, schemas, sinks

T0 = datetime(2024, 1, 1)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def hours(spark, offsets, value=lambda h: float(h)):
    return spark.createDataFrame([(T0 + timedelta(hours=h), value(h)) for h in offsets],
                                 "ts timestamp_ntz, measure double")


# --- quantiles and ranks ----------------------------------------------------
def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000).round(2), np.zeros(2000), [1e9, -1e9]])
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(len(x)) % 2, "x": x}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    # a coarse sketch leaves many candidates, so ranks must come from the second pass
    got = {r["g"]: r["q"] for r in qt.quantiles(df, "x", probs, ["g"], accuracy=500).collect()}
    for g in (0, 1):
        assert got[g] == pytest.approx(np.quantile(x[np.arange(len(x)) % 2 == g], probs))
    assert one(qt.quantiles(df, "x", probs, accuracy=500))["q"] == \
        pytest.approx(np.quantile(x, probs))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30))
def test_quantiles_any_list(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    assert one(qt.quantiles(df, "x", [0.25, 0.5, 0.9]))["q"] == \
        pytest.approx(np.quantile(xs, [0.25, 0.5, 0.9]))


def test_average_ranks_match_pandas(spark):
    xs = [3, 1, 1, 2, 5, 5, 5, -4] * 40
    got = {r["x"]: r["rank"] for r in average_ranks(
        spark.createDataFrame([(x,) for x in xs], "x int"), "x").collect()}
    want = pd.Series(xs).rank().groupby(pd.Series(xs)).first()
    assert got == want.to_dict()


def test_spearman_hot_value(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 50, 900), rng.normal(size=900)
    x[:300] = 7                                   # a third of the rows share one value
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    assert one(sx.spearman(df, "x", "y"))["rho"] == pytest.approx(
        pd.Series(x).rank().corr(pd.Series(y).rank()))


# --- cleaning ---------------------------------------------------------------
RAW = [
    ("New Years Day", "250.0", "0.0", "0.0", "10", "Clear", "sky", "2024-01-01 00:00:00", "100"),
    ("None", "250.0", "0.0", "0.0", "10", " Snow ", "snow", "2024-01-01 00:00:00", "100"),
    ("None", "0.0", "0.0", "0.0", "20", "Clouds", None, "2024-01-01 01:00:00", "200"),
    ("None", "0.0", "0.0", "0.0", "20", "Clouds", None, "2024-01-01 01:00:00", "200"),
    ("None", "260.0", "9831.3", "0.0", "30", "Rain", "rain", "2024-01-02 02:00:00", None),
    ("None", "260.0", "0.1", "0.0", "40", "Rain", "rain", "not a time", "300"),
    ("None", "270.0", "0.2", "0.0", "x", "Fog", "fog", "2024-01-02 03:00:00", "0"),
]


def raw(spark):
    text = spark.createDataFrame(RAW, schemas.RAW_TEXT)
    return readers.cast_text(text, schemas.RAW_TYPED, {"holiday": "None"})


def test_clean_order_and_values(spark):
    rows = {r["ts"]: r for r in cl.clean(raw(spark)).collect()}
    assert len(rows) == 4
    midnight = rows[datetime(2024, 1, 1)]
    # the tagged row lost to the severe one, yet its tag was spread first
    assert midnight["weather_main"] == "Snow" and midnight["holiday"] == "New Years Day"
    assert rows[datetime(2024, 1, 1, 1)]["is_holiday"] == 1
    assert rows[datetime(2024, 1, 2, 2)]["is_holiday"] == 0
    # 0 K replaced by the January median of the valid rows of the kept table
    assert rows[datetime(2024, 1, 1, 1)]["temp"] == 260.0
    assert rows[datetime(2024, 1, 2, 2)]["rain_1h"] == 0.0
    assert rows[datetime(2024, 1, 2, 2)]["traffic_volume"] == 100.0
    assert rows[datetime(2024, 1, 2, 3)]["clouds_all"] == 20.0
    assert rows[datetime(2024, 1, 1, 1)]["weather_description"] == "Unknown"


def test_audit_counts(spark):
    got = {(r["step"], r["reason"]): r["rows_affected"] for r in cl.audit(raw(spark)).collect()}
    assert got[("parse", "timestamp could not be parsed")] == 1
    assert got[("standardise", "blanks around weather_main")] == 1
    assert got[("standardise", "holiday spread over tagged dates")] == 3
    assert got[("dedup", "identical rows")] == 1
    assert got[("dedup", "repeated timestamps")] == 1
    assert got[("impute", "temp out of range")] == 1
    assert got[("output", "rows kept")] == 4


def test_audited_run_cleans_alike_and_takes_nothing(spark):
    rows, report = cl.clean_audited(raw(spark))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, cl.clean(raw(spark)).collect()), key=str)
    assert rows.columns == cl.clean(raw(spark)).columns and report.count() > 10
    stage = spark.read.parquet(sinks.write_stage(raw(spark).limit(0), work_dir(spark, "nothing")))
    rows, report = cl.clean_audited(stage)
    assert rows.count() == 0
    assert {r["reason"] for r in report.collect() if r["rows_affected"]} == set()


def test_all_bad_month_falls_through_to_global_median(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 0.0), (datetime(2024, 2, 1), 280.0),
                                (datetime(2024, 2, 2), 290.0)],
                               "ts timestamp_ntz, temp double")
    fixed = cl.impute_range(df, {"temp": config.TEMP_BOUNDS_K})
    assert fixed.where("temp is null").count() == 1
    full = cl.fill_missing(fixed, ["temp"], [])
    assert full.where("month(ts) = 1").first()["temp"] == 285.0


def test_keep_best_tie_takes_smallest_key(spark):
    df = spark.createDataFrame([(T0, 9, "a"), (T0, 2, "a"), (T0, 5, "z")],
                               "ts timestamp_ntz, id int, c string")
    best = win.keep_best(df, "ts", fc.ordinal("c", {"a": 1}, -1), ["id"])
    assert one(best)["id"] == 2


# --- features ---------------------------------------------------------------
def test_cyclic_neighbours(spark):
    s, c = fc.cyclic("h", 24)
    rows = spark.createDataFrame([(23,), (0,), (12,)], "h int").select(s.alias("s"), c.alias("c"))
    late, zero, noon = [(r["s"], r["c"]) for r in rows.collect()]
    assert math.dist(late, zero) < 0.3 < math.dist(zero, noon)


def test_quartile_edge_is_inclusive_and_null_has_no_level(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5)] + [(None,)],
                               "measure double")
    got = {r["measure"]: (r["congestion_level"], r["congestion_code"], r["is_congested"])
           for r in fx.quartile_target(df, "measure", 4).collect()}
    assert got == {1.0: ("Low", 0, 0), 2.0: ("Low", 0, 0), 3.0: ("Moderate", 1, 0),
                   4.0: ("High", 2, 0), 5.0: ("Severe", 3, 1), None: (None, -1, 0)}


def test_rare_threshold_is_strict(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)], "category string")
    got = fx.rare_to_other(df, "category", 3).collect()
    assert sorted(str(r["category_grouped"]) for r in got) == ["None", "Other", "Other",
                                                                "a", "a", "a"]


def test_a_common_category_does_not_meet_in_one_task(spark, monkeypatch):
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "CASE WHEN id < 3 THEN 'b' WHEN id = 3 THEN NULL ELSE 'a' END AS category")
    # as with large tables: only the measured size tells that the rare side is small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    try:
        for rows in (df, df.where("id > 2")):               # also where no category is rare
            assert max(map(len, fx.rare_to_other(rows, "category", 4).rdd.glom().collect())) <= 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    got = {tuple(r) for r in fx.rare_to_other(df, "category", 4).collect()}
    monkeypatch.setattr(fx, "NAMES", 0)                     # names that are joined give the same
    assert got == {tuple(r) for r in fx.rare_to_other(df, "category", 4).collect()} and len(got) == 4000


def test_feature_table_is_42_wide(spark):
    clean = cl.clean(raw(spark)).withColumnRenamed("ts", "date_time")
    out = fx.build(clean, ts="date_time", category="weather_main", measure="traffic_volume")
    assert len(clean.columns) == 10 and len(out.columns) == 42
    assert set(config.FEATURE_COLUMNS) <= set(out.columns)


def test_request_features_equal_training_features(spark):
    cond = spark.createDataFrame([(datetime(2018, 6, 16, 8), "Rain", 20.0, 40, 1.5, 0.0, False)],
                                 schemas.CONDITIONS)
    row = one(fx.from_conditions(cond))
    assert list(row) == config.FEATURE_COLUMNS
    assert row["is_weekend"] == 1 and row["weather_Rain"] == 1 and row["has_rain"] == 1
    assert row["temp"] == pytest.approx(293.15) and row["is_precipitation"] == 1


def test_stratified_split_is_exact(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "id int, y int")
    got = fx.split_stratified(df, "id", "y")
    assert got.count() == 1000
    counts = {r["y"]: r["n"] for r in got.where("is_test").groupBy("y").agg(
        F.count("*").alias("n")).collect()}
    assert counts == {0: 180, 1: 20}


def test_range_predicates_keep_null(spark):
    df = spark.createDataFrame([(None,), (50.0,), (101.0,)], "v double")
    got = [r["reasons"] for r in rel.check_bounds(df, {"v": (0, 100)}).collect()]
    assert got == [["v"], [], ["v"]]


# --- windows ----------------------------------------------------------------
def test_history_needs_every_hour(spark):
    df = hours(spark, [h for h in range(80) if h != 40])
    got = sorted(r["ts"] for r in win.history(df, "ts", ["measure"], "measure",
                                              block_hours=30).collect())
    ok = [h for h in range(24, 80) if h != 40 and not (h - 24 <= 40 < h)]
    assert got == [T0 + timedelta(hours=h) for h in ok]
    row = one(win.contiguity(df, "ts", block_hours=30))
    assert (row["n_candidates"], row["n_kept"]) == (79 - 24, len(ok))


def test_history_is_in_time_order(spark):
    first = win.history(hours(spark, range(30)), "ts", ["measure"], "measure").orderBy("ts").first()
    assert [h["measure"] for h in first["history"]] == [float(h) for h in range(24)]


def test_two_equal_runs_first_wins(spark):
    df = spark.createDataFrame([(h,) for h in (1, 2, 5, 6, 9)], "hour int")
    runs = win.consecutive_runs(df, "hour")
    assert runs.count() == 3
    assert one(win.longest_run(runs)) == {"run_start": 1, "run_end": 2, "run_length": 2}


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.77, 0.8, 0.99, 1.0])
def test_chrono_split_tells_ties_apart_by_key(spark, fraction):
    times = [T0 + timedelta(hours=h) for h in [0, 1, 1, 1, 1, 1, 2, 2, 3]]
    keys = [5, 9, 2, 7, 4, 8, 1, 6, 3]
    df = spark.createDataFrame(list(zip(times, keys)), "ts timestamp_ntz, key long").repartition(3)
    order = sorted(zip(times, keys))
    want = set(order[:math.floor(fraction * len(order))])
    got = win.chrono_split(df, "ts", fraction, key="key").collect()
    assert {(r["ts"], r["key"]) for r in got if r["is_train"]} == want and len(got) == 9


def test_chrono_split_floors(spark):
    got = win.chrono_split(hours(spark, range(7)), "ts")
    assert got.where("is_train").count() == 5          # floor(0.8 * 7)


def test_nearest_tie_goes_to_the_earlier(spark):
    df = hours(spark, [0, 4, 300])
    probes = hours(spark, [2, 3, 4, 150, 400]).select(F.col("ts").alias("probe_ts"))
    got = {r["probe_hour"]: r["nearest_hour"] for r in rel.nearest(df, probes,
                                                                   block_hours=24).collect()}
    at = lambda h: T0 + timedelta(hours=h)             # noqa: E731
    assert got == {at(2): at(0), at(3): at(4), at(4): at(4), at(150): at(4), at(400): at(300)}
    assert one(rel.nearest_to(df, at(2)))["ts"] == at(0)


def test_coverage_spine_lists_missing_hours(spark):
    spine = ag.coverage_spine(hours(spark, [0, 1, 4]), "ts", "hour")
    assert spine.count() == 5 and spine.where("is_missing").count() == 2


def test_duplicate_profile(spark):
    df = hours(spark, [0, 0, 0, 1]).unionByName(hours(spark, [1], lambda h: -1.0))
    assert one(ag.duplicate_profile(df)) == {"n_rows": 5, "exact_duplicates": 2,
                                             "repeated_timestamps": 1}


def test_histogram_last_bin_is_closed(spark):
    got = {r["bin"]: r["n"] for r in ag.histogram(hours(spark, range(11)), "measure", 5).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


# --- statistics and evaluation ----------------------------------------------
def test_skewness_matches_pandas(spark):
    xs = [1.0, 2.0, 2.5, 9.0, 30.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert one(sx.skewness(df, "x"))["skewness"] == pytest.approx(pd.Series(xs).skew())


def test_chi_square_uses_the_correction(spark):
    # published counts of a known table: 35.917 corrected, 36.089 uncorrected
    rows = [(1, 1)] * 1763 + [(1, 0)] * (7100 - 1763) + [(0, 1)] * (13391 - 1763) \
        + [(0, 0)] * (48204 - 7100 - 13391 + 1763)
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["a", "b"]))
    got = one(sx.chi_square_2x2(df, F.col("a") == 1, F.col("b") == 1))
    assert got["chi2"] == pytest.approx(35.917, abs=1e-3)
    assert got["p_value"] == pytest.approx(2.1e-9, rel=0.05)
    assert one(sx.chi_square_2x2(df, F.col("a") == 1, F.col("b") == 1, yates=False))["chi2"] \
        == pytest.approx(36.089, abs=1e-3)


def test_t_tail():
    assert 10 ** sx._log10_t_tail(2.0, 10) == pytest.approx(0.07338803, rel=1e-6)
    z = 0.5 / math.sqrt(3)                            # closed form for three degrees
    exact = 1 - 2 / math.pi * (math.atan(z) + z / (1 + z * z))
    assert 10 ** sx._log10_t_tail(0.5, 3) == pytest.approx(exact, rel=1e-9)
    # far below the smallest double the logarithm stays finite
    assert -400 < sx._log10_t_tail(40.0, 5000) < -250


def test_confusion_and_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "y int, prediction int")
    row = one(ev.precision_recall(ev.confusion(df)))
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 2, 0)
    assert row["precision"] == 0.0 and row["recall"] == 0.0 and row["f1"] == 0.0


def test_auc_reversed_and_ties(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 400), rng.integers(0, 20, 400) / 20
    df = spark.createDataFrame(pd.DataFrame({"y": y, "score": s}))
    auc = one(ev.roc_auc(df))["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert auc == pytest.approx(brute)
    flipped = df.withColumn("score", -F.col("score"))
    assert one(ev.roc_auc(flipped))["roc_auc"] == pytest.approx(1 - auc)


def test_silhouette_brute_force(spark):
    rng = np.random.default_rng(7)
    x, lab = rng.normal(size=(60, 2)), rng.integers(0, 3, 60)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "l": lab}))
    dist = ((x[:, None] - x) ** 2).sum(-1)
    want = []
    for i in range(60):
        mean = [dist[i][(lab == c) & (np.arange(60) != i)].mean() for c in range(3)]
        a, b = mean[lab[i]], min(m for c, m in enumerate(mean) if c != lab[i])
        want.append((b - a) / max(a, b))
    assert one(cu.silhouette(df, ["a", "b"], "l"))["silhouette"] == pytest.approx(np.mean(want))


# --- rules ------------------------------------------------------------------
def _rule_frame(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"band": rng.choice(["x", "y", "z"], 400),
                        "day": rng.choice(["wd", "we"], 400)})
    pdf["level"] = np.where(pdf["band"] == "x", "Low", rng.choice(["Low", "High"], 400))
    pdf.loc[:20, "band"] = None
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                 "band string, day string, level string")


def test_cube_itemsets_equal_growth(spark):
    df, attrs = _rule_frame(spark), ["band", "day", "level"]
    pack = lambda s: {tuple(r["items"]): r["n"] for r in s.collect()}      # noqa: E731
    cube = pack(ru.itemsets(df, attrs))
    assert cube == pack(ru.itemsets_fpgrowth(df, attrs))
    for items, n in cube.items():                     # support never grows with the set
        for drop in items:
            rest = tuple(i for i in items if i != drop)
            assert not rest or cube[rest] >= n


def test_certain_rule_has_infinite_conviction(spark):
    r = ru.metrics(ru.rules(ru.itemsets(_rule_frame(spark), ["band", "day", "level"]), "level"))
    row = r.where(F.array_join("antecedent", "|") == "band=x").where(
        "consequent = 'level=Low'").first()
    assert row["confidence"] == 1.0 and math.isinf(row["conviction"])


# --- drift ------------------------------------------------------------------
def _psi(spark, ref, cur):
    df = spark.createDataFrame([(float(v), False) for v in ref] + [(float(v), True) for v in cur],
                               "f double, c boolean")
    return one(dr.psi(df, F.col("c"), ["f"]))["psi"]


def psi_by_counting(reference, current, floor=1e-6):
    """The index from its definition: deciles of the sorted reference, rows per decile, shares of all rows."""
    ranked = sorted(float(v) for v in reference)

    def decile(i):
        at = i / 10 * (len(ranked) - 1)
        low = ranked[math.floor(at)]
        return low + (ranked[math.ceil(at)] - low) * (at - math.floor(at))

    cuts = sorted({decile(i) for i in range(11)})

    def shares(values):
        held = dict.fromkeys(range(1, len(cuts)), 0)
        for v in values:
            if v == cuts[-1]:
                held[len(cuts) - 1] += 1
            elif 0 < bisect_right(cuts, v) < len(cuts):
                held[bisect_right(cuts, v)] += 1
        return [max(floor, n / len(values)) for n in held.values()]

    if len(cuts) <= 2:
        return 0.0
    return sum((now - was) * math.log(now / was) for was, now in zip(shares(reference), shares(current)))


def test_psi_matches_its_definition(spark):
    rng = np.random.default_rng(13)
    ref, cur = rng.normal(size=500).round(2), rng.normal(0.5, 1.2, 300).round(2)
    assert _psi(spark, ref, cur) == pytest.approx(psi_by_counting(ref, cur))
    assert _psi(spark, ref, ref) == pytest.approx(0)
    ties = np.repeat([0, 1, 2, 3], [300, 50, 100, 50])     # repeated edges, values outside
    assert _psi(spark, ties, [1, 2, 2, 7, -3]) == pytest.approx(psi_by_counting(ties, [1, 2, 2, 7, -3]))
    assert _psi(spark, [0] * 65 + [1] * 36, [1] * 40) == 0.0        # two edges cannot drift


def test_error_drift_perfect_reference(spark):
    df = spark.createDataFrame([(1.0, 1.0, False), (1.0, 3.0, True)],
                               "y double, prediction double, c boolean")
    row = one(dr.error_drift(df, F.col("c")))
    assert math.isinf(row["ratio"]) and row["status"] == "ALERT"


# --- recommendation ---------------------------------------------------------
def test_recommendation_text_and_fallback(spark):
    # Monday to Sunday, every hour; quietest 6, 7 and 9, busiest 20
    means = {h: 100.0 + h for h in range(24)} | {6: 10.0, 7: 11.0, 9: 12.0, 20: 999.0}
    rows = [(T0 + timedelta(hours=h), means[h % 24], "Rain" if h % 24 == 8 else "Clear")
            for h in range(24 * 7)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, measure double, category string")
    got = one(rc.recommend(df, "weekday", "Rain", min_n=200))
    assert [h["hour"] for h in got["recommended_hours"]] == [6, 7, 9]
    assert (got["run_start"], got["run_end"]) == (6, 7)
    assert "For a weekday journey in rain conditions, consider travelling between 06:00 and " \
           "08:00" in got["recommendation"]
    assert "Avoid 20:00" in got["recommendation"]
    thin = rc.profile(df, "weekday", "Rain", min_n=200).collect()
    assert len(thin) == 24 and thin[0]["is_fallback"]
    own = rc.profile(df, "weekday", "Rain", min_n=1).collect()
    assert [r["hour"] for r in own] == [8] and not own[0]["is_fallback"]


def test_bad_windows_are_rejected(spark):
    for a, b in ((-1, 5), (3, 24), (9, 8)):
        with pytest.raises(ValueError):
            rel.hour_window(hours(spark, [0]), a, b)
    with pytest.raises(ValueError):
        rel.by_day_type(hours(spark, [0]), "holiday")


# --- sources ----------------------------------------------------------------
def test_csv_keeps_bad_lines_countable(spark):
    path = work_dir(spark, "bad-csv")
    spark.createDataFrame([("a,b",), ("1,2",), ("x,3",)], "v string").coalesce(1) \
        .write.text(path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b",
                                                                               T.IntegerType())])
    rows = readers.scan_csv(spark, path, schema).collect()
    assert sum(r["_corrupt"] is not None for r in rows) == 1 and len(rows) == 2


def test_schema_check_and_required_columns(spark):
    df = hours(spark, [0])
    got = {r["column"]: r["status"] for r in readers.schema_check(df, ["ts", "tag"]).collect()}
    assert got == {"ts": "ok", "tag": "missing", "measure": "extra"}
    with pytest.raises(ValueError, match="tag"):
        readers.require_columns(df, ["ts", "tag"])


def test_ledger_keeps_first_best_run(spark):
    path = work_dir(spark, "ledger")
    for run, value in (("run_1", 0.5), ("run_2", 0.9), ("run_3", 0.9)):
        m = spark.createDataFrame([("m", value)], "model string, auc double")
        sinks.record_run(sinks.ledger_rows(m, "risk", run, "model", ["auc"]), path)
    assert one(sinks.best_run(sinks.read_ledger(spark, path), "auc"))["run"] == "run_2"


def test_ledger_survives_a_retry(spark):
    path = work_dir(spark, "ledger")

    def record(run, value, experiment="a b/c=1"):
        m = spark.createDataFrame([("m1", value), ("m2", 0.1)], "model string, auc double")
        sinks.record_run(sinks.ledger_rows(m, experiment, run, "model", ["auc"]), path)

    def held():
        return {(r["experiment"], r["run"], r["model"]): r["value"] for r in sinks.read_ledger(spark, path).collect()}

    record("1", 0.5)
    record("2", 0.6)
    record("1", 0.5)                # the same job again
    assert sinks.read_ledger(spark, path).count() == 4
    record("1", 0.7)                # a corrected run replaces its own rows only
    record("1", 0.9, "other")
    assert held() == {("a b/c=1", "1", "m1"): 0.7, ("a b/c=1", "1", "m2"): 0.1, ("a b/c=1", "2", "m1"): 0.6,
                      ("a b/c=1", "2", "m2"): 0.1, ("other", "1", "m1"): 0.9, ("other", "1", "m2"): 0.1}


def test_catalogue_table_is_replaced(spark):
    name = sinks.create_table(spark.createDataFrame([(1, "a"), (2, None)], "n int, t string"), "replaced")
    assert spark.table(name).count() == 2
    again = sinks.create_table(spark.createDataFrame([(7.5,)], "n double"), "replaced")
    assert again == name and spark.table(name).dtypes == [("n", "double")] and one(spark.table(name))["n"] == 7.5
    shown = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} n").collect()}
    assert shown["max"] == "7.5" and shown["distinct_count"] == "1"


def test_tag_dates_prune_the_partitions_read(spark):
    rows = hours(spark, range(24 * 20)).withColumn("day", F.to_date("ts"))
    stage = spark.read.parquet(sinks.write_stage(rows.repartition("day"), work_dir(spark, "days"), ["day"]))
    days = sorted(r["day"] for r in rows.select("day").distinct().collect())
    dim = spark.createDataFrame([(days[3], "a"), (days[3], "b"), (days[11], "c"), (days[5], None)],
                                "tag_date date, tag string")
    dim = spark.read.parquet(sinks.write_stage(dim, work_dir(spark, "tags")))
    out = rel.join_tagged_dates(stage.drop("tag"), dim, "day")
    got = out.collect()
    assert {(r["day"], r["tag"]) for r in got} == {(days[3], "b"), (days[11], "c")} and len(got) == 48
    plan = out._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    leaves = plan.executedPlan().collectLeaves() if plan.nodeName() == "AdaptiveSparkPlan" else plan.collectLeaves()
    read, todo = [], [leaves.apply(i) for i in range(leaves.size())]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            more = node.plan().collectLeaves()
            todo += [more.apply(i) for i in range(more.size())]
        elif node.metrics().contains("numFiles"):
            read.append((node.metrics().apply("numFiles").value(), "day" in node.toString() and "measure" in node.toString()))
    assert [n for n, own in read if own] == [2]         # one file a day, two tagged days


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(base) and work_dir(spark, "x") != work_dir(spark, "x")
