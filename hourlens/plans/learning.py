"""Cleaning, features, models, evaluation, drift and recommendations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.operators import attribution as sh
from hourlens.operators import cleaning as cl
from hourlens.operators import clustering as cu
from hourlens.operators import drift as dr
from hourlens.operators import evaluation as ev
from hourlens.operators import features as fx
from hourlens.operators import models as md
from hourlens.operators import recommend as rc
from hourlens.operators import recurrent as rn
from hourlens.operators import windows as win
from hourlens.plans.analytics import rounded
from hourlens.plans.derived import CLEAN, predictions, scores
from hourlens.plans.registry import query
from hourlens.session import work_dir
from hourlens.sources import views
from hourlens.sources.sinks import write_stage

# --- cleaning ---------------------------------------------------------------
@query("clean_parse_drop", """SELECT event_id, TRY_CAST(date_time AS TIMESTAMP) AS ts FROM obs_raw
    WHERE TRY_CAST(date_time AS TIMESTAMP) IS NOT NULL""")
def clean_parse_drop(spark, d):
    return cl.parse_drop(views.obs_raw(spark, d), "date_time").select("event_id", "ts")


@query("clean_categories", "SELECT ts, event_id, category, tag, is_tag FROM obs_tagged")
def clean_categories(spark, d):
    raw = views.obs_raw(spark, d).withColumn("tag", fc.sentinel_to_null("tag"))
    out = cl.standardise(cl.parse_drop(raw, "date_time"), CLEAN.text, "tag")
    return out.select("ts", "event_id", "category", "tag", "is_tag")


@query("clean_dedup", "SELECT ts, event_id, category, value, tag FROM obs_best")
def clean_dedup(spark, d):
    raw = views.obs_raw(spark, d).withColumn("tag", fc.sentinel_to_null("tag"))
    std = cl.standardise(cl.parse_drop(raw, "date_time"), CLEAN.text, "tag")
    return win.dedup(std, "ts", "category", ["event_id"], views.SEVERITY).select(
        "ts", "event_id", "category", "value", "tag")


@query("clean_outliers", """SELECT event_id, round(CASE WHEN value > 1000 THEN med ELSE value END,
    4) AS value, value > 1000 AS was_bad FROM obs_dirty LEFT JOIN (SELECT month(ts) AS mo,
        median(value) AS med FROM obs_dirty WHERE NOT coalesce(value > 1000, false) GROUP BY 1)
    ON month(ts) = mo""")
def clean_outliers(spark, d):
    df = views.obs_dirty(spark, d).withColumn("was_bad", F.col("value") > 1000)
    return rounded(cl.impute_range(df, {"value": (None, 1000.0)}).select(
        "event_id", "value", "was_bad"), 4, "value")


@query("clean_missing", """SELECT event_id, round(coalesce(value, (SELECT median(value)
        FROM obs_dirty)), 4) AS value, coalesce(nullif(trim(category), 'view'), 'Unknown')
    AS category FROM obs_dirty""")
def clean_missing(spark, d):
    df = views.obs_dirty(spark, d).withColumn(
        "category", fc.sentinel_to_null(fc.strip_text("category"), "view"))
    return rounded(cl.fill_missing(df, ["value"], ["category"]).select(
        "event_id", "value", "category"), 4, "value")


@query("clean_full", """SELECT ts, event_id, user_id, category, round(value, 4) AS value,
    round(k, 4) AS k, tag, is_tag FROM obs_clean""")
def clean_full(spark, d):
    return rounded(cl.clean(views.obs_raw(spark, d), CLEAN), 4, "value", "k").select(
        "ts", "event_id", "user_id", "category", "value", "k", "tag", "is_tag")


# --- features ---------------------------------------------------------------
@query("feat_time", """SELECT event_id, hour, day_of_week, month, year, is_weekend,
    round(hour_sin, 6) + 0.0 AS hour_sin, round(hour_cos, 6) + 0.0 AS hour_cos,
    round(dow_sin, 6) + 0.0 AS dow_sin, round(dow_cos, 6) + 0.0 AS dow_cos FROM ftime""")
def feat_time(spark, d):
    t = fx.add_time(views.obs(spark, d))
    return t.select("event_id", "hour", "day_of_week", "month", "year", "is_weekend", *[
        (F.round(c, 6) + 0.0).alias(c) for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")])


@query("feat_rare_to_other", "SELECT event_id, category, category_grouped FROM fgroup")
def feat_rare_to_other(spark, d):
    return fx.rare_to_other(views.obs(spark, d), "category", 1985).select(
        "event_id", "category", "category_grouped")


@query("feat_one_hot", """SELECT event_id, cat_click, cat_error, cat_purchase, cat_signup,
    cat_view, "cat_Other" FROM feat""")
def feat_one_hot(spark, d):
    g = fx.rare_to_other(views.obs(spark, d), "category", 1985)
    return fx.one_hot(g, "category_grouped", views.LEVELS, "cat").select(
        "event_id", *[f"cat_{v}" for v in views.LEVELS])


@query("feat_unseen_levels", """SELECT category, count(*) AS n FROM obs
    WHERE category NOT IN ('click', 'error') GROUP BY 1""")
def feat_unseen_levels(spark, d):
    return fx.unseen_levels(views.obs(spark, d), "category", ["click", "error"])


@query("feat_flags", """SELECT event_id, is_precipitation, is_low_visibility, has_rain, has_snow,
    round(temp_celsius, 6) AS temp_celsius FROM feat""")
def feat_flags(spark, d):
    f = fx.add_flags(views.feature_input(spark, d), severe=views.SEVERE,
                     low_visibility=views.LOW_VISIBILITY)
    return rounded(f.select("event_id", "is_precipitation", "is_low_visibility", "has_rain",
                            "has_snow", "temp_celsius"), 6, "temp_celsius")


@query("feat_zscore", """SELECT event_id, round(temp_z, 6) AS temp_z, round(clouds_all_z, 6)
    AS clouds_all_z FROM feat""")
def feat_zscore(spark, d):
    z = fx.zscore(views.feature_input(spark, d), ["temp", "clouds_all"])
    return rounded(z.select("event_id", "temp_z", "clouds_all_z"), 6, "temp_z", "clouds_all_z")


@query("feat_minmax", """SELECT event_id, round(temp_minmax, 6) AS temp_minmax,
    round(clouds_all_minmax, 6) AS clouds_all_minmax FROM feat""")
def feat_minmax(spark, d):
    m = fx.minmax(views.feature_input(spark, d), ["temp", "clouds_all"])
    return rounded(m.select("event_id", "temp_minmax", "clouds_all_minmax"), 6, "temp_minmax",
                   "clouds_all_minmax")


@query("feat_scaling_params", """SELECT 'temp' AS "column", round(t_m, 6) AS mean,
    round(t_s, 6) AS std, round(t_lo, 6) AS min, round(t_hi, 6) AS max FROM fstat
    UNION ALL SELECT 'clouds_all', round(c_m, 6), round(c_s, 6), c_lo, c_hi FROM fstat""")
def feat_scaling_params(spark, d):
    p = fx.scaling_params(views.feature_input(spark, d), ["temp", "clouds_all"])
    return rounded(p, 6, "mean", "std", "min", "max")


@query("feat_train_only_scale", """WITH t AS (SELECT *, row_number() OVER (ORDER BY hour_ts)
        <= floor(0.8 * count(*) OVER ()) AS tr FROM hourly),
    s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM t WHERE tr)
    SELECT hour_ts, tr AS is_train, round((value - m) / (sd + 1e-8), 6) AS value_z FROM t, s""")
def feat_train_only_scale(spark, d):
    split = win.chrono_split(views.hourly(spark, d), "hour_ts")
    return rounded(fx.train_only_scale(split, ["value"]).select("hour_ts", "is_train", "value_z"),
                   6, "value_z")


@query("feat_quartile_target", """SELECT event_id, congestion_level,
    CAST(congestion_code AS INTEGER) AS congestion_code, is_congested FROM feat""")
def feat_quartile_target(spark, d):
    t = fx.quartile_target(views.feature_input(spark, d), "measure", 60.0)
    return t.select("event_id", "congestion_level", "congestion_code", "is_congested")


@query("cut_quantile", """SELECT o_orderkey, CASE WHEN volume <= q1 THEN 'Low' WHEN volume <= q2
    THEN 'Moderate' WHEN volume <= q3 THEN 'High' ELSE 'Severe' END AS congestion_level
    FROM daily, (SELECT quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.5) AS q2,
        quantile_cont(volume, 0.75) AS q3 FROM daily)""")
def cut_quantile(spark, d):
    return fx.quartile_target(views.daily(spark, d), "volume").select("o_orderkey",
                                                                      "congestion_level")


@query("feat_proxy_label", "SELECT event_id, high_risk FROM feat")
def feat_proxy_label(spark, d):
    return views.feat(spark, d).select("event_id", "high_risk")


@query("feat_label_balance", """SELECT CAST(sum(high_risk) AS BIGINT) AS n_positive,
    CAST(count(*) - sum(high_risk) AS BIGINT) AS n_negative, round(avg(high_risk), 6) AS rate,
    avg(high_risk) < 0.05 AS is_imbalanced FROM feat""")
def feat_label_balance(spark, d):
    return rounded(fx.label_balance(views.feat(spark, d)), 6, "rate")


_FEAT_COLS = ["event_id", "ts", "category", "category_grouped", "hour", "day_of_week", "month",
              "year", "is_weekend", "is_holiday", "measure", "rain_1h", "snow_1h", "clouds_all",
              "is_precipitation", "is_low_visibility", "has_rain", "has_snow", "congestion_level",
              "congestion_code", "is_congested", "high_risk"]
_FEAT_ROUND = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "temp", "temp_celsius", "temp_z",
               "temp_minmax", "clouds_all_z", "clouds_all_minmax"]


@query("feat_full", "SELECT " + ", ".join(
    [c for c in _FEAT_COLS] + [f'"cat_{v}"' for v in views.LEVELS]
    + [f"round({c}, 6) + 0.0 AS {c}" for c in _FEAT_ROUND]) + " FROM feat")
def feat_full(spark, d):
    return views.feat(spark, d).select(
        *_FEAT_COLS, *[f"cat_{v}" for v in views.LEVELS],
        *[(F.round(c, 6) + 0.0).alias(c) for c in _FEAT_ROUND])


def _conditions(spark, d):
    """Stated conditions taken from the observations."""
    f = views.feature_input(spark, d)
    return f.select("event_id", F.col("ts").alias("timestamp"), F.col("category").alias("weather"),
                    (F.col("temp") - 273.15).alias("temp_celsius"), "clouds_all", "rain_1h",
                    "snow_1h", (F.col("is_holiday") == 1).alias("is_holiday"))


def _condition_features(df):
    return fx.from_conditions(df, levels=views.LEVELS, prefix="cat", severe=views.SEVERE,
                              low_visibility=views.LOW_VISIBILITY, features=views.FEATURES,
                              keep=("event_id",))


@query("feat_from_request", "SELECT event_id, " + ", ".join(
    f"CAST(CAST(category = '{v}' AS INTEGER) AS DOUBLE) AS \"cat_{v}\"" for v in views.LEVELS)
    + ", " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in views.FEATURES
                       if not c.startswith("cat_")) + " FROM feat")
def feat_from_request(spark, d):
    out = _condition_features(_conditions(spark, d))
    return out.select("event_id", *[c if c.startswith("cat_") else (F.round(c, 6) + 0.0).alias(c)
                                    for c in views.FEATURES])


@query("split_random", """SELECT event_id, substr(md5(CAST(event_id AS VARCHAR)), 1, 8)
    < '33333333' AS is_test FROM obs""")
def split_random(spark, d):
    return fx.split_hash(views.obs(spark, d), "event_id").select("event_id", "is_test")


@query("split_stratified", """SELECT event_id, category, row_number() OVER (PARTITION BY category
    ORDER BY md5(CAST(event_id AS VARCHAR)), event_id)
    <= round(0.2 * count(*) OVER (PARTITION BY category)) AS is_test FROM obs""")
def split_stratified(spark, d):
    return fx.split_stratified(views.obs(spark, d), "event_id", "category").select(
        "event_id", "category", "is_test")


@query("assemble_xy", f"""WITH wide AS (SELECT event_id, measure, {", ".join(
    f'CAST("{c}" AS DOUBLE) AS x{i}' for i, c in enumerate(views.FEATURES))} FROM feat)
    SELECT event_id, CAST(substr(name, 2) AS INTEGER) AS position, round(x, 6) AS x, measure AS y
    FROM (UNPIVOT wide ON {", ".join(f"x{i}" for i in range(len(views.FEATURES)))}
          INTO NAME name VALUE x) z""")
def assemble_xy(spark, d):
    """The feature vector, one row per position, beside the target."""
    from pyspark.ml.functions import vector_to_array

    out = md.assemble(views.FEATURES).transform(views.feat(spark, d))
    return out.select("event_id", F.col("measure").alias("y"), F.posexplode(
        vector_to_array("features")).alias("position", "x")).select(
        "event_id", "position", (F.round("x", 6) + F.lit(0.0)).alias("x"), "y")


@query("class_weights", """SELECT high_risk, count(*) AS n, round((SELECT count(*) FROM feat)
    / ((SELECT count(DISTINCT high_risk) FROM feat) * count(*)), 8) AS weight
    FROM feat GROUP BY 1""")
def class_weights(spark, d):
    return rounded(fx.class_weights(views.feat(spark, d), "high_risk"), 8, "weight")


# --- evaluation on given predictions ----------------------------------------
_CONF = """SELECT count(*) FILTER (WHERE y = 0 AND prediction = 0) AS tn,
    count(*) FILTER (WHERE y = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE y = 1 AND prediction = 1) AS tp"""


@query("eval_confusion", f"{_CONF} FROM scores")
def eval_confusion(spark, d):
    return ev.confusion(scores(spark, d))


@query("eval_prf", f"""WITH c AS ({_CONF} FROM scores) SELECT tn, fp, fn, tp,
    round((tp + tn) / (tn + fp + fn + tp), 8) AS accuracy, round(tp / (tp + fp), 8) AS precision,
    round(tp / (tp + fn), 8) AS recall, round(2 * tp / (2 * tp + fp + fn), 8) AS f1 FROM c""")
def eval_prf(spark, d):
    return rounded(ev.precision_recall(ev.confusion(scores(spark, d))), 8, "accuracy",
                   "precision", "recall", "f1")


@query("eval_roc_auc", """WITH r AS (SELECT y, rank() OVER (ORDER BY score)
        + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scores),
    a AS (SELECT sum(rk) FILTER (WHERE y = 1) AS s, CAST(sum(y) AS BIGINT) AS p,
        CAST(sum(1 - y) AS BIGINT) AS n FROM r)
    SELECT round((s - p * (p + 1) / 2.0) / (p * n), 8) AS roc_auc, p AS n_positive,
        n AS n_negative FROM a""")
def eval_roc_auc(spark, d):
    return rounded(ev.roc_auc(scores(spark, d)), 8, "roc_auc")


_REG = """count(*) AS n, round(avg(abs(prediction - y)), 6) AS mae,
    round(sqrt(avg(pow(prediction - y, 2))), 6) AS rmse,
    round(1 - sum(pow(prediction - y, 2)) / (var_pop(y) * count(y)), 6) AS r2"""


@query("eval_regression", f"SELECT {_REG} FROM preds")
def eval_regression(spark, d):
    return rounded(ev.regression_metrics(predictions(spark, d)), 6, "mae", "rmse", "r2")


@query("baseline_majority", "SELECT round(1 - avg(y), 8) AS baseline_accuracy FROM scores")
def baseline_majority(spark, d):
    return rounded(ev.majority_baseline(scores(spark, d)), 8, "baseline_accuracy")


@query("baseline_mean", """WITH s AS (SELECT *, substr(md5(CAST(event_id AS VARCHAR)), 1, 8)
        < '33333333' AS t FROM preds), m AS (SELECT avg(y) AS m FROM s WHERE NOT t),
    b AS (SELECT avg(abs(y - m)) AS b, avg(abs(y - prediction)) AS mae FROM s, m WHERE t)
    SELECT round(b, 6) AS baseline_mae, round(100 * (b - mae) / b, 6) AS pct_better FROM b""")
def baseline_mean(spark, d):
    s = fx.split_hash(predictions(spark, d), "event_id")
    mae = fc.scalar(ev.regression_metrics(s.where("is_test")).select("mae"))["mae"]
    return rounded(ev.improvement(ev.mean_baseline(s), mae), 6, "baseline_mae", "pct_better")


@query("eval_by_slice", f"""SELECT 'hour' AS slice, CAST(hour(ts) AS VARCHAR) AS level, {_REG}
    FROM preds GROUP BY 2 UNION ALL SELECT 'category', category, {_REG} FROM preds GROUP BY 2
    UNION ALL SELECT 'month', CAST(month(ts) AS VARCHAR), {_REG} FROM preds GROUP BY 2""")
def eval_by_slice(spark, d):
    p = predictions(spark, d).withColumns({"hour": F.hour("ts"), "month": F.month("ts")})
    return rounded(ev.by_slice(p, ["hour", "category", "month"]), 6, "mae", "rmse", "r2")


@query("model_compare", """SELECT arg_min(model, struct_pack(v := -v, m := model)) AS best_model,
    round(max(v), 6) AS best_value FROM (
        SELECT 'line' AS model, 1 - sum(pow(prediction - y, 2)) / (var_pop(y) * count(y)) AS v
            FROM preds UNION ALL
        SELECT 'flat', 1 - sum(pow(50 - y, 2)) / (var_pop(y) * count(y)) FROM preds) z""")
def model_compare(spark, d):
    p = predictions(spark, d)
    both = p.select("y", F.explode(F.array(
        F.struct(F.lit("line").alias("model"), F.col("prediction")),
        F.struct(F.lit("flat").alias("model"), F.lit(50.0).alias("prediction")))).alias("_m")) \
        .select("y", "_m.*")
    return rounded(ev.best_by(ev.regression_metrics(both, by=["model"]), "model", "r2"), 6,
                   "best_value")


@query("reg_linear_one", """SELECT round(regr_slope(value, k), 6) AS slope,
    round(regr_intercept(value, k), 6) AS intercept, round(regr_r2(value, k), 6) AS r2 FROM obs""")
def reg_linear_one(spark, d):
    return views.obs(spark, d).agg(
        F.round(F.regr_slope("value", "k"), 6).alias("slope"),
        F.round(F.regr_intercept("value", "k"), 6).alias("intercept"),
        F.round(F.regr_r2("value", "k"), 6).alias("r2"))


@query("forecast_naive", """WITH z AS (SELECT value, lag(value, 24) OVER o AS guess,
        hour_ts - lag(hour_ts, 24) OVER o = INTERVAL 24 HOUR AS ok FROM gappy
        WINDOW o AS (ORDER BY hour_ts))
    SELECT count(*) AS n, round(avg(abs(guess - value)), 6) AS mae,
        round(sqrt(avg(pow(guess - value, 2))), 6) AS rmse,
        round(1 - sum(pow(guess - value, 2)) / (var_pop(value) * count(value)), 6) AS r2
    FROM z WHERE ok""")
def forecast_naive(spark, d):
    h = win.history(views.hourly_gappy(spark, d), "hour_ts", ["value"], "value")
    p = h.select(F.col("target").alias("y"), F.col("history")[0]["value"].alias("prediction"))
    return rounded(ev.regression_metrics(p), 6, "mae", "rmse", "r2")


# --- models -----------------------------------------------------------------
def _features(spark, d):
    """The feature stage table: fits read it many times, its shuffles run once."""
    parts = md.tasks(views.table(spark, d, "events"))       # a footer count: features are one row an event
    rows = views.feat(spark, d).repartition(parts, "event_id")
    return spark.read.parquet(write_stage(rows, work_dir(spark, "features")))


def _split(spark, d, label):
    df = _features(spark, d)
    s = fx.split_stratified(df, "event_id", label) if label == "high_risk" \
        else fx.split_hash(df, "event_id")
    keep = s.select("event_id", "ts", "category", "high_risk", "measure", "is_test",
                    *views.FEATURES)
    return keep.where(~F.col("is_test")), keep.where("is_test")


def _score_clf(model, test):
    return md.score_risk(model, test, ["event_id", "high_risk"]).drop("note")


@query("clf_logistic")
def clf_logistic(spark, d):
    train, test = _split(spark, d, "high_risk")
    return _score_clf(md.fit_logistic(train, views.FEATURES, "high_risk"), test)


@query("clf_forest")
def clf_forest(spark, d):
    train, test = _split(spark, d, "high_risk")
    return _score_clf(md.fit_forest(train, views.FEATURES, "high_risk"), test)


@query("reg_linear")
def reg_linear(spark, d):
    train, test = _split(spark, d, "measure")
    return md.score_regression(md.fit_linear(train, views.FEATURES, "measure"), test,
                               ["event_id", "measure"])


@query("reg_gbt")
def reg_gbt(spark, d):
    train, test = _split(spark, d, "measure")
    return md.score_regression(md.fit_gbt(train, views.FEATURES, "measure"), test,
                               ["event_id", "measure"])


@query("score_batch")
def score_batch(spark, d):
    train, _ = _split(spark, d, "high_risk")
    model = md.fit_logistic(train, views.FEATURES, "high_risk")
    return md.score_risk(model, _condition_features(_conditions(spark, d)), ["event_id"])


def _sequences(spark, d):
    """24 hours of the measure and all model features before each hour of the series."""
    best = views.hourly(spark, d).select("event_id")
    rows = views.feat(spark, d).join(best, "event_id", "left_semi")
    columns = ["measure", *views.FEATURES]
    h = win.history(rows, "hour_ts", columns, "measure")
    lagged = md.lag_features(h, columns).select("hour_ts", "target", "lags")
    stage = spark.read.parquet(write_stage(lagged, work_dir(spark, "sequences")))
    return win.chrono_split(stage, "hour_ts")


@query("forecast_test_rows", """SELECT hour_ts, target FROM (
        SELECT hour_ts, target, row_number() OVER (ORDER BY hour_ts) <= floor(0.8 * count(*) OVER ()) AS train
        FROM (SELECT hour_ts, value AS target, count(*) OVER (ORDER BY hour_ts RANGE BETWEEN
            INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS held FROM hourly) h WHERE held = 24) z
    WHERE NOT train""")
def forecast_test_rows(spark, d):
    """The hours that forecasts are tested on, and what they have to meet."""
    return _sequences(spark, d).where(~F.col("is_train")).select("hour_ts", "target")


@query("forecast_next_step")
def forecast_next_step(spark, d):
    seq = _sequences(spark, d)
    model = md.fit_forecast(seq.where("is_train"))
    return md.score_regression(model, seq.where(~F.col("is_train")), ["hour_ts", "target"])


@query("forecast_recurrent")
def forecast_recurrent(spark, d):
    """The same test hours by a recurrent network over the 24 hours before each."""
    seq = _sequences(spark, d)
    model = rn.fit(seq.where("is_train"), 1 + len(views.FEATURES), "hour_ts", epochs=8)
    return model.transform(seq.where(~F.col("is_train"))).select("hour_ts", "target", "prediction")


@query("error_history")
def error_history(spark, d):
    seq = _sequences(spark, d)
    model = md.fit_forecast(seq.where("is_train"), booster=True, trees=15)
    return md.error_history(model, seq.where("is_train"), seq.where(~F.col("is_train")))


@query("pred_vs_actual")
def pred_vs_actual(spark, d):
    """Every test hour in order."""
    return forecast_next_step(spark, d).orderBy("hour_ts")


def _surrogate(spark, d):
    df = win.chrono_split(_features(spark, d), "ts", key="event_id")
    keep = df.select("event_id", "measure", "is_train", *views.FEATURES)
    train, test = keep.where("is_train"), keep.where(~F.col("is_train"))
    return md.fit_surrogate(train, views.FEATURES, "measure"), test


_TEST = """SELECT event_id, value FROM (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id)
        <= floor(0.8 * count(*) OVER ()) AS train FROM obs) z WHERE {}"""


@query("surrogate_baseline", f"""WITH te AS ({_TEST.format('NOT train')}), tr AS ({_TEST.format('train')})
    SELECT (SELECT count(*) FROM tr) AS n_train, count(*) AS n_test,
        round(avg(abs(value - (SELECT avg(value) FROM tr))), 6) AS mean_mae FROM te""")
def surrogate_baseline(spark, d):
    """Rows of the surrogate's split and the error of always guessing the training mean."""
    df = win.chrono_split(_features(spark, d), "ts", key="event_id")
    mean = fc.fitted(df.where("is_train").agg(F.avg("measure").alias("m")))["m"]
    return df.agg(F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test"),
                  F.round(F.avg(F.when(~F.col("is_train"), F.abs(F.col("measure") - mean))), 6).alias("mean_mae"))


@query("surrogate_gbt")
def surrogate_gbt(spark, d):
    model, test = _surrogate(spark, d)
    return ev.regression_metrics(md.score_regression(model, test, ["measure"]), "measure")


@query("feature_attribution")
def feature_attribution(spark, d):
    """Mean size of each feature's Shapley attribution over all test rows, beside two other measures."""
    model, test = _surrogate(spark, d)
    shap = sh.mean_attribution(sh.explain(model, sh.grouped(model, test, views.FEATURES), views.FEATURES, ["n"]),
                               views.FEATURES, "n")
    imp = md.permutation_importance(model, test, views.FEATURES, "measure", "event_id")
    return shap.join(imp, "feature").join(
        md.split_importance(model, views.FEATURES, spark).withColumnRenamed("importance", "split_gain"), "feature") \
        .orderBy(F.desc("mean_abs"), "feature").limit(10)


@query("attribution_sums", f"SELECT event_id, TRUE AS adds_up FROM ({_TEST.format('NOT train')}) t")
def attribution_sums(spark, d):
    """Do base value and attributions add up to the prediction, for every test row?"""
    df = win.chrono_split(_features(spark, d), "ts", key="event_id").select(
        "event_id", "measure", "is_train", *views.FEATURES)
    model = md.fit_surrogate(df.where("is_train"), views.FEATURES, "measure", trees=10)
    rows = sh.explain(model, df.where(~F.col("is_train")), views.FEATURES, ["event_id"])
    total = F.col("base") + F.aggregate("attribution", F.lit(0.0), lambda s, x: s + x)
    return rows.select("event_id", (F.abs(total - F.col("prediction")) < 1e-6).alias("adds_up"))


_CLUSTER = ["hour", "severity", "measure", "temp_celsius", "is_weekend"]


def _cluster_input(spark, d):
    f = fx.add_flags(fx.add_time(views.feature_input(spark, d)))
    return cu.with_severity(f, "category", views.SEVERITY)


@query("cluster_kmeans")
def cluster_kmeans(spark, d):
    vec = cu.scaled_vector(_cluster_input(spark, d), _CLUSTER)
    return cu.kmeans(vec, 8).transform(vec).select("event_id", "cluster")


@query("cluster_select_k")
def cluster_select_k(spark, d):
    table, _ = cu.select_k(_cluster_input(spark, d), _CLUSTER)
    return table


# --- monitoring -------------------------------------------------------------
_DRIFT = [*views.FEATURES, "day"]       # all model features, and one that has to alert
_CUT = datetime(2024, 1, 20)


# Two hours with one sine are one value: without the last bits, which no two libraries share.
_CYCLIC = {"hour_sin", "hour_cos", "dow_sin", "dow_cos"}


def _drift_input(spark, d):
    return views.feat(spark, d).withColumns(
        {"day": F.dayofmonth("ts"), **{c: F.round(c, 9) for c in _CYCLIC}})


def _is_current():
    return F.col("ts") >= F.lit(_CUT).cast("timestamp_ntz")


_PSI = f"""dlong AS (UNPIVOT (SELECT ts >= TIMESTAMP '2024-01-20' AS cur, {", ".join(
    f'CAST({f"round({c}, 9)" if c in _CYCLIC else f"{chr(34)}{c}{chr(34)}"} AS DOUBLE) AS "{c}"'
    for c in views.FEATURES)}, CAST(day(ts) AS DOUBLE) AS day
        FROM feat) ON {", ".join(f'"{c}"' for c in _DRIFT)} INTO NAME feature VALUE x),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(x,
        [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
    FROM dlong WHERE NOT cur GROUP BY 1),
bins AS (SELECT feature, i, e[i] AS lo, e[i + 1] AS hi, i = len(e) - 1 AS is_last
    FROM (SELECT feature, e, unnest(generate_series(1, len(e) - 1)) AS i FROM edges
          WHERE len(e) >= 3) z),
tot AS (SELECT count(*) FILTER (WHERE NOT cur) AS rn, count(*) FILTER (WHERE cur) AS cn
    FROM dlong WHERE feature = 'day'),
share AS (SELECT b.feature, b.i, greatest(count(x) FILTER (WHERE NOT cur) / max(rn), 1e-6) AS r,
    greatest(count(x) FILTER (WHERE cur) / max(cn), 1e-6) AS c FROM tot, bins b LEFT JOIN dlong d
    ON b.feature = d.feature AND x >= lo AND (x < hi OR (is_last AND x = hi)) GROUP BY 1, 2),
psi AS (SELECT e.feature, coalesce(sum((c - r) * ln(c / r)), 0) AS psi FROM edges e
    LEFT JOIN share s ON e.feature = s.feature GROUP BY 1)"""


def _psi(spark, d):
    return dr.psi(_drift_input(spark, d), _is_current(), _DRIFT)


@query("psi", f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi(spark, d):
    return rounded(_psi(spark, d), 6, "psi")


_BAND = "CASE WHEN psi >= 0.25 THEN 'ALERT' WHEN psi >= 0.1 THEN 'WARN' ELSE 'PASS' END"


@query("feature_drift", f"""WITH {_PSI}, b AS (SELECT feature, round(psi, 6) AS psi,
        {_BAND} AS status FROM psi)
    SELECT *, (SELECT CASE WHEN bool_or(status = 'ALERT') THEN 'ALERT'
        WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END FROM b) AS overall_status,
        (SELECT count(*) FROM b WHERE status <> 'PASS') AS n_drifted FROM b""")
def feature_drift(spark, d):
    return rounded(dr.feature_drift(_psi(spark, d)), 6, "psi")


@query("topk_drift", f"""WITH {_PSI}, b AS (SELECT feature, psi, {_BAND} AS status FROM psi)
    SELECT feature, round(psi, 6) AS psi, status FROM b WHERE status <> 'PASS'
    ORDER BY round(b.psi, 9) DESC, feature LIMIT 5""")
def topk_drift(spark, d):
    return rounded(dr.top_drift(dr.feature_drift(_psi(spark, d))).select(
        "feature", "psi", "status"), 6, "psi")


_ERR = """SELECT avg(abs(prediction - y)) FILTER (WHERE ts < TIMESTAMP '2024-01-20') AS r,
    avg(abs(prediction - y)) FILTER (WHERE ts >= TIMESTAMP '2024-01-20') AS c FROM preds"""


@query("error_drift", f"""SELECT round(r, 6) AS reference_mae, round(c, 6) AS current_mae,
    round(c / r, 6) AS ratio, CASE WHEN c / r >= 1.25 THEN 'ALERT' ELSE 'PASS' END AS status
    FROM ({_ERR}) z""")
def error_drift(spark, d):
    return rounded(dr.error_drift(predictions(spark, d), _is_current()), 6, "reference_mae",
                   "current_mae", "ratio")


@query("drift_report", f"""WITH {_PSI}, b AS (SELECT feature, psi, {_BAND} AS status FROM psi),
    e AS (SELECT r, c, CASE WHEN c / r >= 1.25 THEN 'ALERT' ELSE 'PASS' END AS s FROM ({_ERR}) z),
    f AS (SELECT CASE WHEN bool_or(status = 'ALERT') THEN 'ALERT' WHEN bool_or(status = 'WARN')
        THEN 'WARN' ELSE 'PASS' END AS s, count(*) FILTER (WHERE status <> 'PASS') AS n FROM b)
    SELECT '2024-01-20' AS split_date,
        (SELECT count(*) FROM obs WHERE ts < TIMESTAMP '2024-01-20') AS reference_rows,
        (SELECT count(*) FROM obs WHERE ts >= TIMESTAMP '2024-01-20') AS current_rows,
        (SELECT count(*) FROM obs WHERE ts >= TIMESTAMP '2024-01-20') < 500 AS is_noisy,
        f.s AS feature_status, f.n AS n_drifted,
        (SELECT round(psi, 4) FROM b WHERE feature = 'day') AS day_psi, e.s AS error_status,
        round(r, 1) AS reference_mae, round(c, 1) AS current_mae, round(c / r, 3) AS ratio,
        CASE WHEN 'ALERT' IN (f.s, e.s) THEN 'ALERT' WHEN f.s = 'WARN' THEN 'WARN' ELSE 'PASS'
        END AS overall_status FROM f, e""")
def drift_report(spark, d):
    drift = dr.feature_drift(_psi(spark, d))
    errors = dr.error_drift(predictions(spark, d), _is_current())
    rep = dr.report(views.obs(spark, d), _is_current(), drift, errors, "2024-01-20")
    fd, ed = F.col("feature_drift"), F.col("error_drift")
    return rep.select("split_date", "reference_rows", "current_rows", "is_noisy",
                      fd["status"].alias("feature_status"), fd["n_drifted"].alias("n_drifted"),
                      fd["per_feature"]["day"]["psi"].alias("day_psi"),
                      ed["status"].alias("error_status"),
                      ed["reference_mae"].alias("reference_mae"),
                      ed["current_mae"].alias("current_mae"), ed["ratio"].alias("ratio"),
                      "overall_status")


# --- recommendation ---------------------------------------------------------
@query("profile_with_fallback", """WITH b AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, category,
        value FROM obs WHERE isodow(ts) < 6),
    t AS (SELECT count(*) FILTER (WHERE category = 'error') < 200 AS thin FROM b)
    SELECT hour, round(avg(value), 6) AS mean, count(value) AS n, thin AS is_fallback
    FROM b, t WHERE thin OR category = 'error' GROUP BY hour, thin""")
def profile_with_fallback(spark, d):
    return rounded(rc.profile(views.obs(spark, d), "weekday", "error", measure="value"), 6,
                   "mean")


# One recommendation per (day type, category); `pick` narrows it to one request.
_REC = """base AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, category, value,
        unnest(['all', CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday' END]) AS day_type
        FROM obs),
size AS (SELECT day_type, category, count(*) < 200 AS thin FROM base GROUP BY 1, 2),
prof AS (SELECT s.day_type, s.category, s.thin, b.hour, avg(b.value) AS mean FROM size s
    JOIN base b ON s.day_type = b.day_type AND (s.thin OR s.category = b.category)
    GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day_type, category ORDER BY mean, hour)
    AS rk, row_number() OVER (PARTITION BY day_type, category ORDER BY mean DESC, hour DESC)
    AS back FROM prof WHERE hour BETWEEN 6 AND 20),
whole AS (SELECT day_type, category, avg(mean) AS overall FROM prof GROUP BY 1, 2),
isl AS (SELECT day_type, category, hour, hour - row_number() OVER (
    PARTITION BY day_type, category ORDER BY hour) AS g FROM ranked WHERE rk <= 3),
runs AS (SELECT day_type, category, CAST(min(hour) AS INTEGER) AS s,
    CAST(max(hour) AS INTEGER) AS e FROM isl GROUP BY day_type, category, g),
longest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day_type, category
    ORDER BY e - s DESC, s) AS n FROM runs) z WHERE n = 1),
rec AS (SELECT w.day_type, w.category, z.thin AS is_fallback, h.hours,
    a.hour AS busiest, round(a.mean, 1) AS busiest_mean, a.mean AS worst, b.mean AS best,
    100 * (overall - b.mean) / overall AS saving, l.s AS run_start, l.e AS run_end
    FROM whole w JOIN size z USING (day_type, category) JOIN longest l USING (day_type, category)
    JOIN (SELECT * FROM ranked WHERE rk = 1) b USING (day_type, category)
    JOIN (SELECT * FROM ranked WHERE back = 1) a USING (day_type, category)
    JOIN (SELECT day_type, category, string_agg(concat(hour, ':', round(mean, 1)), ','
        ORDER BY rk) AS hours FROM ranked WHERE rk <= 3 GROUP BY 1, 2) h
        USING (day_type, category)),
answer AS (SELECT day_type, category, is_fallback, hours, busiest AS busiest_hour, busiest_mean,
    round(saving, 1) AS percent_below_average, run_start, run_end,
    concat('For ', CASE day_type WHEN 'weekday' THEN 'a weekday' WHEN 'weekend' THEN 'a weekend'
        ELSE 'any' END, ' journey in ', lower(category), ' conditions, consider travelling ',
        CASE WHEN run_end > run_start THEN format('between {:02d}:00 and {:02d}:00', run_start,
            run_end + 1) ELSE format('around {:02d}:00', run_start) END,
        ', when historical traffic volumes average ', CAST(round_even(best, 0) AS BIGINT),
        ' vehicles/hour — about ', CAST(round_even(saving, 0) AS BIGINT),
        '% below the daily average. Avoid ', format('{:02d}:00', busiest),
        ', the busiest hour in this window at ', CAST(round_even(worst, 0) AS BIGINT),
        ' vehicles/hour.') AS recommendation FROM rec)"""


def _flat(rec):
    hours = F.array_join(F.transform("recommended_hours", lambda h: F.concat_ws(
        ":", h["hour"].cast("string"), h["mean_volume"].cast("string"))), ",")
    return rec.select("day_type", "category", *(["is_fallback"] if "is_fallback" in rec.columns
                                                else []),
                      hours.alias("hours"), F.col("busiest_hour")["hour"].alias("busiest_hour"),
                      F.col("busiest_hour")["mean_volume"].alias("busiest_mean"),
                      "percent_below_average", "run_start", "run_end", "recommendation")


@query("recommend", f"""WITH {_REC} SELECT * EXCLUDE (is_fallback) FROM answer
    WHERE day_type = 'weekday' AND category = 'error'""")
def recommend(spark, d):
    return _flat(rc.recommend(views.obs(spark, d), "weekday", "error", measure="value"))


@query("recommend_all", f"WITH {_REC} SELECT * FROM answer")
def recommend_all(spark, d):
    return _flat(rc.recommend_all(views.obs(spark, d), measure="value"))
