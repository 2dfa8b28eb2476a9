"""Aggregates, windows, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.operators import aggregates as ag
from hourlens.operators import clustering as cu
from hourlens.operators import cleaning as cl
from hourlens.operators import features as fx
from hourlens.operators import relational as rel
from hourlens.operators import rules as ru
from hourlens.operators import silhouettes as sil
from hourlens.operators import stats as st
from hourlens.operators import windows as win
from hourlens.plans.registry import query
from hourlens.sources import views


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- aggregates -------------------------------------------------------------
@query("agg_yearly", """SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS hours_recorded,
    round(sum(volume), 2) AS total_volume, round(avg(volume), 1) AS mean_volume
    FROM daily WHERE year(ts) BETWEEN 1995 AND 2000 GROUP BY 1""")
def agg_yearly(spark, d):
    y = ag.yearly(rel.in_years(views.daily(spark, d), "ts", 1995, 2000), "volume")
    return y.select("year", "hours_recorded", F.round("total", 2).alias("total_volume"),
                    F.round("mean", 1).alias("mean_volume"))


@query("agg_monthly_count", """SELECT strftime(ts, '%Y-%m') AS month, count(*) AS hours_recorded
    FROM daily WHERE strftime(ts, '%Y-%m') BETWEEN '1996-01' AND '1997-12' GROUP BY 1""")
def agg_monthly_count(spark, d):
    return ag.monthly_count(rel.in_years(views.daily(spark, d), "ts", 1996, 1997))


@query("agg_holiday_year", """SELECT t.tag, CAST(t.yr AS INTEGER) AS year, min(t.tag_date)
    AS tag_date, count(*) AS hours_recorded, round(avg(volume), 2) AS mean_volume,
    round(min(volume), 2) AS min_volume, round(max(volume), 2) AS max_volume
    FROM daily d JOIN (SELECT DISTINCT tag, CAST(ts AS DATE) AS tag_date, year(ts) AS yr
        FROM daily_tagged WHERE tag IS NOT NULL AND year(ts) BETWEEN 1996 AND 2000) t
    ON CAST(d.ts AS DATE) = t.tag_date GROUP BY 1, 2""")
def agg_holiday_year(spark, d):
    dim = rel.tag_dates(rel.in_years(views.daily_tagged(spark, d), "ts", 1996, 2000))
    return rel.join_dim_back(views.daily(spark, d), dim).groupBy("tag", "year").agg(
        F.min("tag_date").alias("tag_date"), F.count("*").alias("hours_recorded"),
        F.round(F.avg("volume"), 2).alias("mean_volume"),
        F.round(F.min("volume"), 2).alias("min_volume"),
        F.round(F.max("volume"), 2).alias("max_volume"))


@query("agg_annual_context", """SELECT CAST(year(ts) AS INTEGER) AS year,
    round(avg(volume), 2) AS mean_volume, round(avg(o_custkey), 2) AS mean_custkey FROM daily
    WHERE year(ts) BETWEEN 1996 AND 2000 AND volume > 2000 GROUP BY 1""")
def agg_annual_context(spark, d):
    return (rel.in_years(views.daily(spark, d), "ts", 1996, 2000).where("volume > 2000")
            .groupBy(F.year("ts").alias("year"))
            .agg(F.round(F.avg("volume"), 2).alias("mean_volume"),
                 F.round(F.avg("o_custkey"), 2).alias("mean_custkey")))


@query("agg_hourly_profile", """SELECT CAST(isodow(hour_ts) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(hour_ts) AS INTEGER) AS hour, round(avg(value), 6) AS mean, count(value) AS n
    FROM hourly GROUP BY 1, 2""")
def agg_hourly_profile(spark, d):
    p = ag.hourly_profile(views.hourly(spark, d), "value", "hour_ts",
                          [fc.weekend_flag("hour_ts").alias("is_weekend")])
    return rounded(p, 6, "mean")


@query("agg_category_mean_count", """SELECT category, round(avg(value), 6) AS mean,
    count(value) AS n, count(value) < 2000 AS is_small FROM obs GROUP BY 1""")
def agg_category_mean_count(spark, d):
    return rounded(ag.category_profile(views.obs(spark, d), "category", "value", 2000), 6, "mean")


@query("agg_category_range", """WITH p AS (SELECT category, avg(value) AS mean, count(value) AS n
        FROM obs GROUP BY 1)
    SELECT round(min(mean), 6) AS min_mean, round(max(mean), 6) AS max_mean,
        round(max(mean) - min(mean), 6) AS range_all,
        round(min(mean) FILTER (WHERE n >= 2000), 6) AS min_mean_reliable,
        round(max(mean) FILTER (WHERE n >= 2000), 6) AS max_mean_reliable,
        round(max(mean) FILTER (WHERE n >= 2000) - min(mean) FILTER (WHERE n >= 2000), 6)
            AS range_reliable FROM p""")
def agg_category_range(spark, d):
    r = ag.category_range(ag.category_profile(views.obs(spark, d), "category", "value", 2000))
    return rounded(r, 6, *r.columns)


@query("agg_weekday_weekend", """WITH b AS (SELECT isodow(ts) >= 6 AS we, value FROM obs),
    a AS (SELECT avg(value) FILTER (WHERE NOT we) AS wdm,
        median(value) FILTER (WHERE NOT we) AS wdq, count(*) FILTER (WHERE NOT we) AS wdn,
        avg(value) FILTER (WHERE we) AS wem, median(value) FILTER (WHERE we) AS weq,
        count(*) FILTER (WHERE we) AS wen FROM b)
    SELECT round(wdm, 6) AS weekday_mean, round(wdq, 6) AS weekday_median, wdn AS weekday_n,
        round(wem, 6) AS weekend_mean, round(weq, 6) AS weekend_median, wen AS weekend_n,
        round(wdm - wem, 6) AS difference, round(100 * (wdm - wem) / wem, 6) AS pct_vs_weekend
    FROM a""")
def agg_weekday_weekend(spark, d):
    r = ag.weekday_weekend(views.obs(spark, d), "value")
    return rounded(r, 6, *[c for c in r.columns if not c.endswith("_n")])


@query("agg_compare_conditions", """SELECT category, round(avg(value), 6) AS mean,
    count(value) AS n, count(value) < 2000 AS is_small FROM obs
    WHERE category IN ('click', 'view') GROUP BY 1""")
def agg_compare_conditions(spark, d):
    asked = views.obs(spark, d).where(F.col("category").isin("click", "view"))
    return rounded(ag.category_profile(asked, "category", "value", 2000), 6, "mean")


def _labelled(spark, d):
    """Cluster labels both engines derive the same way."""
    o = views.obs(spark, d)
    label = (F.floor(F.hour("ts") / 6) + 4 * fc.weekend_flag("ts")).cast("int")
    return o.select("event_id", label.alias("cluster"), F.hour("ts").alias("hour"),
                    F.col("value").alias("measure"),
                    fc.ordinal("category", views.SEVERITY, 0).alias("severity"),
                    F.col("k").alias("temp"), fc.weekend_flag("ts").alias("is_weekend"))


_LABELLED = """labelled AS (SELECT event_id, CAST(hour(ts) // 6
    + 4 * CAST(isodow(ts) >= 6 AS INTEGER) AS INTEGER) AS cluster, hour(ts) AS hour,
    value AS measure, CASE category WHEN 'error' THEN 4 WHEN 'purchase' THEN 3
        WHEN 'signup' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS severity, k AS temp,
    CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM obs)"""
_PROFILE = """SELECT cluster, count(*) AS n, round(avg(hour), 2) AS mean_hour,
    round(avg(measure), 2) AS mean_measure, round(avg(severity), 2) AS mean_severity,
    round(avg(temp), 2) AS mean_temp, round(avg(is_weekend), 2) AS weekend_share
    FROM labelled GROUP BY 1"""
_PROFILE_COLS = ("mean_hour", "mean_measure", "mean_severity", "mean_temp", "weekend_share")


@query("agg_cluster_profile", f"WITH {_LABELLED} {_PROFILE}")
def agg_cluster_profile(spark, d):
    return rounded(ag.cluster_profile(_labelled(spark, d)), 2, *_PROFILE_COLS)


_INTERPRET = f"""WITH {_LABELLED}, p AS ({_PROFILE}),
    m AS (SELECT median(measure) AS med FROM labelled)
    SELECT p.*, concat(CASE WHEN mean_measure > med THEN 'high-volume ' ELSE 'low-volume ' END,
        CASE WHEN mean_hour < 6 THEN 'overnight' WHEN mean_hour < 11 THEN 'morning'
             WHEN mean_hour < 15 THEN 'midday' WHEN mean_hour < 20 THEN 'afternoon/evening'
             ELSE 'late evening' END, ' hours, ',
        CASE WHEN weekend_share > 0.5 THEN 'mostly weekend, ' ELSE 'mostly weekday, ' END,
        CASE WHEN mean_severity > 2 THEN 'adverse weather' ELSE 'mild weather' END,
        ' (n=', format('{{:,}}', n), ', mean volume ',
        CAST(CAST(round_even(mean_measure, 0) AS BIGINT) AS VARCHAR), ')') AS interpretation
    FROM p, m"""


@query("cluster_interpret", _INTERPRET)
def cluster_interpret(spark, d):
    df = _labelled(spark, d)
    profile = rounded(ag.cluster_profile(df), 2, *_PROFILE_COLS)
    return cu.interpret(profile, cu.overall_median(df, "measure"))


@query("cluster_text", _INTERPRET.replace("SELECT p.*,", "SELECT p.cluster,"))
def cluster_text(spark, d):
    return cluster_interpret(spark, d).select("cluster", "interpretation")


@query("agg_value_counts", "SELECT category, count(*) AS n FROM obs GROUP BY 1")
def agg_value_counts(spark, d):
    return views.obs(spark, d).groupBy("category").agg(F.count("*").alias("n"))


@query("agg_distinct", """SELECT count(DISTINCT category) AS n_categories,
    count(DISTINCT hour_ts) AS n_hours, count(DISTINCT user_id) AS n_users FROM obs""")
def agg_distinct(spark, d):
    """Each column is reduced to its distinct values on its own shuffle-light path."""
    o = views.obs(spark, d)
    n = {c: fc.scalar(o.select(c).distinct().agg(F.count(c).alias("n")))["n"]
         for c in ("category", "hour_ts", "user_id")}
    return spark.range(1).select(n["category"].alias("n_categories"), n["hour_ts"]
                                 .alias("n_hours"), n["user_id"].alias("n_users"))


@query("agg_conditional_count", """SELECT count(*) FILTER (WHERE value > 60) AS n_busy,
    count(*) FILTER (WHERE k = 0) AS n_zero, count(*) FILTER (WHERE category = 'error') AS n_error,
    round(avg(CAST(value > 60 AS INTEGER)), 8) AS share_busy FROM obs""")
def agg_conditional_count(spark, d):
    return views.obs(spark, d).agg(
        fc.count_rows(F.col("value") > 60).alias("n_busy"),
        fc.count_rows(F.col("k") == 0).alias("n_zero"),
        fc.count_rows(F.col("category") == "error").alias("n_error"),
        F.round(fc.mean_flag(F.col("value") > 60), 8).alias("share_busy"))


@query("agg_coverage", """WITH m AS (SELECT date_trunc('month', ts) AS month, count(*) AS n
        FROM daily GROUP BY 1)
    SELECT CAST(month AS TIMESTAMP) AS month, n, (SELECT median(n) FROM m) AS median_n,
        n < 180 AS is_low FROM m""")
def agg_coverage(spark, d):
    return ag.coverage(views.daily(spark, d), low=180)


@query("coverage_spine", """WITH c AS (SELECT hour_ts, count(*) AS n FROM gappy GROUP BY 1),
    s AS (SELECT unnest(generate_series((SELECT min(hour_ts) FROM c),
        (SELECT max(hour_ts) FROM c), INTERVAL 1 HOUR)) AS period)
    SELECT period, coalesce(n, 0) AS n, coalesce(n, 0) = 0 AS is_missing
    FROM s LEFT JOIN c ON period = hour_ts""")
def coverage_spine(spark, d):
    return ag.coverage_spine(views.hourly_gappy(spark, d), "hour_ts", "hour")


@query("histogram_equal_width", """WITH r AS (SELECT min(volume) AS lo, max(volume) AS hi
        FROM daily)
    SELECT CAST(least(floor((volume - lo) / (hi - lo) * 60) + 1, 60) AS INTEGER) AS bin,
        count(*) AS n FROM daily, r GROUP BY 1""")
def histogram_equal_width(spark, d):
    return ag.histogram(views.daily(spark, d), "volume")


@query("binned_mean", """SELECT CAST(ceil((k - 30 + 30) / 2.5) - 1 AS INTEGER) AS bin,
    round(avg(value), 6) AS mean, count(*) AS n,
    (ceil((k - 30 + 30) / 2.5) - 1) * 2.5 - 28.75 AS centre FROM obs
    WHERE k - 30 > -30 AND k - 30 <= 37.5 GROUP BY 1, 4""")
def binned_mean(spark, d):
    df = views.obs(spark, d).withColumn("celsius", (F.col("k") - 30).cast("double"))
    return rounded(ag.binned_mean(df, "celsius", "value"), 6, "mean")


@query("agg_kpi", """SELECT count(*) AS n, round(avg(value), 6) AS mean_measure,
    round(avg(k), 6) AS mean_other, round(avg(k) FILTER (WHERE k > 0), 6) AS mean_other_valid
    FROM obs WHERE hour(ts) BETWEEN 6 AND 20 AND category IN ('click', 'view')""")
def agg_kpi(spark, d):
    sliced = rel.hour_window(views.obs(spark, d), 6, 20).where(
        F.col("category").isin("click", "view"))
    r = ag.kpi(sliced, "value", "k", F.col("k") > 0)
    return rounded(r, 6, "mean_measure", "mean_other", "mean_other_valid")


@query("pivot_contingency", """SELECT a, b, (SELECT count(*) FROM obs WHERE (value > 60) = a
        AND (category = 'click') = b) AS n
    FROM (VALUES (true), (false)) x(a), (VALUES (true), (false)) y(b)""")
def pivot_contingency(spark, d):
    return ag.contingency(views.obs(spark, d), F.col("value") > 60, F.col("category") == "click")


@query("median_by_month_valid", """SELECT CAST(month(ts) AS INTEGER) AS month,
    'volume' AS "column", round(median(volume), 4) AS median FROM daily
    WHERE volume BETWEEN 2000 AND 450000 GROUP BY 1""")
def median_by_month_valid(spark, d):
    checks = cl.range_check({"volume": (2000.0, 450000.0)})
    return rounded(cl.valid_medians(views.daily(spark, d), checks), 4, "median")


@query("null_profile", """SELECT 'value' AS "column", count(*) - count(value) AS n_null
    FROM obs_dirty UNION ALL SELECT 'k', count(*) - count(k) FROM obs_dirty
    UNION ALL SELECT 'category', count(*) - count(category) FROM obs_dirty""")
def null_profile(spark, d):
    return ag.null_profile(views.obs_dirty(spark, d), ["value", "k", "category"])


@query("duplicate_profile", """WITH u AS (SELECT hour_ts, count(*) AS c FROM obs_dirty
        GROUP BY event_id, hour_ts, ts, user_id, category, value, k)
    SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c) - count(*) AS BIGINT)
        AS exact_duplicates, count(*) - count(DISTINCT hour_ts) AS repeated_timestamps FROM u""")
def duplicate_profile(spark, d):
    return ag.duplicate_profile(views.obs_dirty(spark, d), "hour_ts")


# --- windows ----------------------------------------------------------------
@query("lag_yoy", """WITH y AS (SELECT CAST(year(ts) AS INTEGER) AS year,
        count(*) AS hours_recorded, CAST(round(sum(volume)) AS BIGINT) AS total,
        avg(volume) AS mean FROM daily WHERE year(ts) BETWEEN 1995 AND 2000 GROUP BY 1),
    p AS (SELECT *, lag(total) OVER w AS pt, lag(mean) OVER w AS pm FROM y
          WINDOW w AS (ORDER BY year))
    SELECT year, hours_recorded, total, round(mean, 1) AS mean, total - pt AS total_change,
        round(100.0 * (total - pt) / pt, 1) AS total_pct_change,
        round(mean - pm, 4) AS mean_change, round(100.0 * (mean - pm) / pm, 1) AS mean_pct_change
    FROM p""")
def lag_yoy(spark, d):
    y = ag.yearly(rel.in_years(views.daily(spark, d), "ts", 1995, 2000), "volume").withColumn(
        "total", F.round("total").cast("bigint"))
    out = win.lag_change(y, "year", ["total", "mean"])
    return rounded(rounded(out, 1, "mean", "total_pct_change", "mean_pct_change"), 4,
                   "mean_change")


@query("lag_partitioned", """WITH y AS (SELECT t.tag, CAST(year(d.ts) AS INTEGER) AS year,
        avg(volume) AS mean FROM daily d JOIN (SELECT DISTINCT tag, CAST(ts AS DATE) AS day_
            FROM daily_tagged WHERE tag IS NOT NULL) t ON CAST(d.ts AS DATE) = t.day_
        GROUP BY 1, 2)
    SELECT tag, year, round(mean, 2) AS mean, round(mean - lag(mean) OVER (PARTITION BY tag
        ORDER BY year), 2) AS mean_change FROM y""")
def lag_partitioned(spark, d):
    dim = rel.tag_dates(views.daily_tagged(spark, d))
    y = rel.join_dim_back(views.daily(spark, d), dim).groupBy("tag", "year").agg(
        F.avg("volume").alias("mean"))
    return rounded(win.lag_change(y, "year", ["mean"], ["tag"], pct=False), 2, "mean",
                   "mean_change")


@query("dedup_keep_best", "SELECT hour_ts, event_id, category, value, k, sev FROM hourly")
def dedup_keep_best(spark, d):
    return views.hourly(spark, d)


@query("drop_exact_duplicates", """SELECT DISTINCT event_id, hour_ts, ts, user_id, category,
    value, k FROM obs_dirty""")
def drop_exact_duplicates(spark, d):
    return views.obs_dirty(spark, d).dropDuplicates()


_LAG24 = """SELECT *, hour_ts - lag(hour_ts, 24) OVER (ORDER BY hour_ts) = INTERVAL 24 HOUR
    AS ok, row_number() OVER (ORDER BY hour_ts) AS rn FROM gappy"""


@query("lag_n_contiguity", f"""SELECT count(*) AS n_hours, greatest(count(*) - 24, 0)
    AS n_candidates, count(*) FILTER (WHERE ok) AS n_kept,
    greatest(count(*) - 24, 0) - count(*) FILTER (WHERE ok) AS n_dropped FROM ({_LAG24}) z""")
def lag_n_contiguity(spark, d):
    return win.contiguity(views.hourly_gappy(spark, d), "hour_ts")


@query("frame_history_array", """WITH z AS (SELECT hour_ts, value, hour_ts - lag(hour_ts, 24)
        OVER o = INTERVAL 24 HOUR AS ok, lag(value, 24) OVER o AS first_value,
        lag(value, 1) OVER o AS last_value, sum(value) OVER f AS total, sum(k) OVER f AS total_k
        FROM gappy WINDOW o AS (ORDER BY hour_ts),
        f AS (ORDER BY hour_ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    SELECT hour_ts, value AS target, 24 AS n_steps, first_value, last_value,
        round(total, 4) AS total_value, CAST(total_k AS BIGINT) AS total_k FROM z WHERE ok""")
def frame_history_array(spark, d):
    h = win.history(views.hourly_gappy(spark, d), "hour_ts", ["value", "k"], "value")

    def fold(field, kind):
        return F.aggregate("history", F.lit(0).cast(kind), lambda a, x: a + x[field].cast(kind))

    return h.select("hour_ts", "target", F.size("history").alias("n_steps"),
                    F.col("history")[0]["value"].alias("first_value"),
                    F.col("history")[23]["value"].alias("last_value"),
                    F.round(fold("value", "double"), 4).alias("total_value"),
                    fold("k", "bigint").alias("total_k"))


_QUIET = """SELECT day(hour_ts) AS day_, hour(hour_ts) AS hour FROM gappy WHERE value < 50"""


@query("runs_of_consecutive", f"""WITH q AS ({_QUIET}), g AS (SELECT day_, hour,
        hour - row_number() OVER (PARTITION BY day_ ORDER BY hour) AS grp FROM q)
    SELECT CAST(day_ AS INTEGER) AS day, CAST(min(hour) AS INTEGER) AS run_start,
        CAST(max(hour) AS INTEGER) AS run_end, count(*) AS run_length FROM g
    GROUP BY day_, grp""")
def runs_of_consecutive(spark, d):
    quiet = views.hourly_gappy(spark, d).where("value < 50").select(
        F.dayofmonth("hour_ts").alias("day"), F.hour("hour_ts").alias("hour"))
    return win.consecutive_runs(quiet, "hour", ["day"])


@query("longest_run", f"""WITH q AS ({_QUIET}), g AS (SELECT day_, hour,
        hour - row_number() OVER (PARTITION BY day_ ORDER BY hour) AS grp FROM q),
    r AS (SELECT day_, min(hour) AS s, max(hour) AS e, count(*) AS n FROM g GROUP BY day_, grp),
    k AS (SELECT *, row_number() OVER (PARTITION BY day_ ORDER BY n DESC, s) AS rn FROM r)
    SELECT CAST(day_ AS INTEGER) AS day, CAST(s AS INTEGER) AS run_start,
        CAST(e AS INTEGER) AS run_end, n AS run_length FROM k WHERE rn = 1""")
def longest_run(spark, d):
    return win.longest_run(runs_of_consecutive(spark, d), ["day"])


@query("rank_enumerate", """SELECT CAST(row_number() OVER (ORDER BY mean, hour) AS INTEGER)
    AS rank, hour, round(mean, 6) AS mean FROM (SELECT CAST(hour(ts) AS INTEGER) AS hour,
        avg(value) AS mean FROM obs GROUP BY 1) p""")
def rank_enumerate(spark, d):
    p = ag.hourly_profile(views.obs(spark, d), "value").drop("n")
    return rounded(win.enumerate_ranked(p, [F.col("mean"), F.col("hour")]), 6, "mean")


@query("chronological_split", """SELECT hour_ts, event_id, row_number() OVER (ORDER BY hour_ts)
    <= floor(0.8 * count(*) OVER ()) AS is_train FROM gappy""")
def chronological_split(spark, d):
    return win.chrono_split(views.hourly_gappy(spark, d), "hour_ts").select(
        "hour_ts", "event_id", "is_train")


# --- statistics -------------------------------------------------------------
@query("describe_measure", """SELECT count(volume) AS count, round(avg(volume), 4) AS mean,
    round(median(volume), 4) AS median, round(stddev_samp(volume), 4) AS std,
    round(var_samp(volume), 0) AS variance, min(volume) AS min, max(volume) AS max,
    round(max(volume) - min(volume), 4) AS range FROM daily""")
def describe_measure(spark, d):
    r = rounded(st.describe(views.daily(spark, d), "volume"), 4, "mean", "median", "std", "range")
    return rounded(r, 0, "variance")


@query("quartiles", """SELECT round(quantile_cont(volume, 0.25), 6) AS q1,
    round(quantile_cont(volume, 0.5), 6) AS q2, round(quantile_cont(volume, 0.75), 6) AS q3
    FROM daily""")
def quartiles(spark, d):
    return rounded(st.quartiles(views.daily(spark, d), "volume"), 6, "q1", "q2", "q3")


@query("skewness_unbiased", "SELECT round(skewness(value), 6) AS skewness FROM obs")
def skewness_unbiased(spark, d):
    return rounded(st.skewness(views.obs(spark, d), "value"), 6, "skewness")


@query("coef_variation", "SELECT round(stddev_samp(value) / avg(value), 6) AS cv FROM obs")
def coef_variation(spark, d):
    return rounded(st.coef_variation(views.obs(spark, d), "value"), 6, "cv")


@query("pearson_two_filters", """SELECT round(corr(k, value), 6) AS r_all,
    round(corr(k, value) FILTER (WHERE k > 0), 6) AS r_valid,
    count(*) FILTER (WHERE k > 0) AS n_valid,
    round(pow(corr(k, value) FILTER (WHERE k > 0), 2), 6) AS r2_valid FROM obs""")
def pearson_two_filters(spark, d):
    r = st.corr_pair(views.obs(spark, d), "k", "value", F.col("k") > 0)
    return rounded(r, 6, "r_all", "r_valid", "r2_valid")


@query("pearson_pvalue")
def pearson_pvalue(spark, d):
    return st.pearson_pvalue(views.obs(spark, d), "k", "value")


@query("pearson_t_statistic", """SELECT round(r, 6) AS r, n,
    round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t FROM (SELECT corr(k, value) AS r, count(*) AS n
    FROM obs) z""")
def pearson_t_statistic(spark, d):
    r = st.pearson_pvalue(views.obs(spark, d), "k", "value")
    return r.select(F.round("r", 6).alias("r"), "n", F.round("t", 5).alias("t"))


@query("spearman", """WITH r AS (SELECT rank() OVER (ORDER BY k)
        + (count(*) OVER (PARTITION BY k) - 1) / 2.0 AS rx, rank() OVER (ORDER BY value)
        + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS ry FROM obs)
    SELECT round(corr(rx, ry), 6) AS rho, count(*) AS n FROM r""")
def spearman(spark, d):
    return rounded(st.spearman(views.obs(spark, d), "k", "value"), 6, "rho")


_NUM = ["value", "k", "hour", "day", "user_id"]


@query("corr_matrix", "WITH n AS (SELECT value, k, hour(ts) AS hour, day(ts) AS day, user_id "
       "FROM obs) " + " UNION ALL ".join(
           f"SELECT '{a}' AS x, '{b}' AS y, round("
           + ("1.0" if a == b else f"corr({a}, {b})") + ", 3) AS r FROM n"
           + (" GROUP BY 1, 2, 3" if a == b else "")
           for a in _NUM for b in _NUM).replace("round(1.0, 3)", "1.0::DOUBLE"))
def corr_matrix(spark, d):
    df = views.obs(spark, d).select("value", "k", F.hour("ts").alias("hour"),
                                    F.dayofmonth("ts").alias("day"), "user_id")
    return rounded(st.corr_matrix(df, _NUM), 3, "r")


def _events():
    return F.col("value") > 60, F.col("category") == "click"


@query("event_probabilities", """SELECT n, n_a, n_b, n_ab, round(n_a / n, 8) AS p_a,
    round(n_b / n, 8) AS p_b, round(n_ab / n, 8) AS p_ab FROM (SELECT count(*) AS n,
        count(*) FILTER (WHERE value > 60) AS n_a, count(*) FILTER (WHERE category = 'click')
        AS n_b, count(*) FILTER (WHERE value > 60 AND category = 'click') AS n_ab FROM obs) z""")
def event_probabilities(spark, d):
    return rounded(st.event_probabilities(views.obs(spark, d), *_events()), 8, "p_a", "p_b",
                   "p_ab")


@query("conditional_probability", """SELECT round(count(*) FILTER (WHERE value > 60
        AND category = 'click') / count(*) FILTER (WHERE value > 60), 8) AS p_b_given_a,
    round(count(*) FILTER (WHERE value > 60 AND k > 70) / count(*) FILTER (WHERE value > 60), 8)
        AS p_c_given_a, round(avg(CAST(category = 'click' AS INTEGER)), 8) AS p_b,
    round(avg(CAST(k > 70 AS INTEGER)), 8) AS p_c FROM obs""")
def conditional_probability(spark, d):
    a, b = _events()
    r = st.conditional_probability(views.obs(spark, d), a, b, F.col("k") > 70)
    return rounded(r, 8, *r.columns)


@query("independence_test", """WITH p AS (SELECT avg(CAST(value > 60 AS INTEGER)) AS a,
        avg(CAST(category = 'click' AS INTEGER)) AS b,
        avg(CAST(value > 60 AND category = 'click' AS INTEGER)) AS ab FROM obs)
    SELECT round(ab, 8) AS p_ab, round(a * b, 8) AS expected, round(ab - a * b, 8) AS difference,
        round(ab / (a * b), 8) AS observed_over_expected FROM p""")
def independence_test(spark, d):
    r = st.independence(views.obs(spark, d), *_events())
    return rounded(r, 8, *r.columns)


@query("chi_square_2x2", """WITH c AS (SELECT value > 60 AS a, category = 'click' AS b,
        count(*) AS o FROM obs GROUP BY 1, 2),
    e AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b)
        / sum(o) OVER () AS x FROM c)
    SELECT round(sum(pow(greatest(abs(o - x) - 0.5, 0), 2) / x), 6) AS chi2, 1 AS dof FROM e""")
def chi_square_2x2(spark, d):
    return rounded(st.chi_square_2x2(views.obs(spark, d), *_events()), 6, "chi2").drop("p_value")


@query("chi_square_pvalue")
def chi_square_pvalue(spark, d):
    return st.chi_square_2x2(views.obs(spark, d), *_events())


@query("odds_ratio", """SELECT a, b, c, d, round(a / b, 8) AS odds_left,
    round(c / d, 8) AS odds_right, round((a / b) / (c / d), 8) AS odds_ratio,
    round((c / d) / (a / b), 8) AS reciprocal FROM (SELECT
        count(*) FILTER (WHERE category = 'click' AND value > 60) AS a,
        count(*) FILTER (WHERE category = 'click' AND NOT value > 60) AS b,
        count(*) FILTER (WHERE category = 'view' AND value > 60) AS c,
        count(*) FILTER (WHERE category = 'view' AND NOT value > 60) AS d FROM obs) z""")
def odds_ratio(spark, d):
    r = st.odds_ratio(views.obs(spark, d), F.col("value") > 60, "category", "click", "view")
    return rounded(r, 8, "odds_left", "odds_right", "odds_ratio", "reciprocal")


# --- itemsets and rules -----------------------------------------------------
ATTRS = ["time_band", "day_type", "weather_band", "temp_band", "congestion_level"]


def _attrs(spark, d):
    df = fx.quartile_target(fx.add_time(views.feature_input(spark, d)), "measure", 60.0)
    return ru.attributes(df.withColumn("temp_celsius", F.col("k") - 30), fair=views.FAIR)


_ATTR_SQL = """attrs AS MATERIALIZED (SELECT CASE WHEN hour <= 5 THEN 'night' WHEN hour <= 9
        THEN 'morning_peak' WHEN hour <= 15 THEN 'midday' WHEN hour <= 19 THEN 'evening_peak'
        ELSE 'late_evening' END AS time_band,
    CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END AS day_type,
    CASE WHEN category IN ('view', 'click') THEN 'fair_weather' ELSE 'adverse_weather' END
        AS weather_band,
    CASE WHEN k - 30 <= 0 THEN 'freezing' WHEN k - 30 <= 15 THEN 'cool'
         WHEN k - 30 <= 50 THEN 'warm' END AS temp_band,
    CASE WHEN measure <= q1 THEN 'Low' WHEN measure <= q2 THEN 'Moderate'
         WHEN measure <= q3 THEN 'High' ELSE 'Severe' END AS congestion_level
    FROM ftime, fstat),
cells AS MATERIALIZED (SELECT time_band, day_type, weather_band, temp_band, congestion_level,
    grouping(time_band) AS g1, grouping(day_type) AS g2, grouping(weather_band) AS g3,
    grouping(temp_band) AS g4, grouping(congestion_level) AS g5, count(*) AS n
    FROM attrs GROUP BY CUBE (time_band, day_type, weather_band, temp_band, congestion_level)),
sets AS MATERIALIZED (SELECT concat_ws('|', 'congestion_level=' || congestion_level, 'day_type=' || day_type,
        'temp_band=' || temp_band, 'time_band=' || time_band, 'weather_band=' || weather_band)
        AS items,
    concat_ws('|', 'day_type=' || day_type, 'temp_band=' || temp_band,
        'time_band=' || time_band, 'weather_band=' || weather_band) AS body,
    'congestion_level=' || congestion_level AS head, g5, n,
    n / (SELECT count(*) FROM attrs) AS support FROM cells
    WHERE g1 + g2 + g3 + g4 + g5 < 5 AND (g4 = 1 OR temp_band IS NOT NULL)
      AND n / (SELECT count(*) FROM attrs) >= 0.02)"""

_RULES_SQL = """rules AS (SELECT s.body, s.head, s.support, a.support AS sa, c.support AS sc
    FROM sets s JOIN sets a ON s.body = a.items JOIN sets c ON s.head = c.items
    WHERE s.g5 = 0 AND s.body <> '' AND s.support / a.support / c.support >= 1.02)"""


@query("frequent_itemsets", f"""WITH {_ATTR_SQL}
    SELECT items, n, round(support, 8) AS support FROM sets""")
def frequent_itemsets(spark, d):
    s = ru.itemsets(_attrs(spark, d), ATTRS)
    return s.select(F.array_join("items", "|").alias("items"), "n",
                    F.round("support", 8).alias("support"))


@query("frequent_itemsets_growth", f"""WITH {_ATTR_SQL}
    SELECT items, n, round(support, 8) AS support FROM sets""")
def frequent_itemsets_growth(spark, d):
    s = ru.itemsets_fpgrowth(_attrs(spark, d), ATTRS)
    return s.select(F.array_join("items", "|").alias("items"), "n",
                    F.round("support", 8).alias("support"))


def _rules(spark, d):
    return ru.rules(ru.itemsets(_attrs(spark, d), ATTRS), "congestion_level", 1.02)


@query("association_rules", f"""WITH {_ATTR_SQL}, {_RULES_SQL}
    SELECT body AS antecedent, head AS consequent, round(support, 8) AS support,
        round(sa, 8) AS antecedent_support, round(sc, 8) AS consequent_support,
        round(support / sa, 8) AS confidence, round(support / sa / sc, 8) AS lift FROM rules""")
def association_rules(spark, d):
    r = _rules(spark, d).withColumn("antecedent", F.array_join("antecedent", "|"))
    return rounded(r, 8, "support", "antecedent_support", "consequent_support", "confidence",
                   "lift")


@query("rule_metrics", f"""WITH {_ATTR_SQL}, {_RULES_SQL}
    SELECT body AS antecedent, head AS consequent, 1.0::DOUBLE AS representativity,
        round(support - sa * sc, 8) AS leverage,
        round((1 - sc) / (1 - support / sa), 8) AS conviction,
        round((support - sa * sc) / greatest(support * (1 - sa), sa * (sc - support)), 8)
            AS zhangs_metric,
        round(support / (sa + sc - support), 8) AS jaccard,
        round((support / sa - sc) / (1 - sc), 8) AS certainty,
        round((support / sa + support / sc) / 2, 8) AS kulczynski FROM rules""")
def rule_metrics(spark, d):
    names = ["leverage", "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski"]
    m = ru.metrics(_rules(spark, d))
    return rounded(m.select(F.array_join("antecedent", "|").alias("antecedent"), "consequent",
                            "representativity", *names), 8, *names)


@query("topk_rules", f"""WITH {_ATTR_SQL}, {_RULES_SQL}
    SELECT replace(body, '|', ', ') AS antecedents, head AS consequent,
        round(support / sa / sc, 6) AS lift FROM rules
    ORDER BY round(support / sa / sc, 9) DESC, 1, 2 LIMIT 8""")
def topk_rules(spark, d):
    return ru.top(_rules(spark, d), 8).select("antecedents", "consequent",
                                              F.round("lift", 6).alias("lift"))


@query("rule_text", f"""WITH {_ATTR_SQL}, {_RULES_SQL}
    SELECT head AS consequent, concat('When ', replace(replace(body, '|', ', '), '=', ' is '),
        ', ', replace(head, 'congestion_level=', 'congestion is '), ' in ',
        CAST(CAST(round_even(100 * round(support / sa, 4), 0) AS BIGINT) AS VARCHAR),
        '% of hours — ', format('{{:.2f}}', round(support / sa / sc, 3)),
        'x more likely than the base rate.') AS plain_language FROM rules""")
def rule_text(spark, d):
    return ru.sentence(_rules(spark, d)).select("consequent", "plain_language")


_ALL_PAIRS = """d AS (SELECT a.event_id AS id, a.cluster AS own, b.cluster AS other, sum({distance}) AS s,
        count(*) AS n FROM labelled a, labelled b GROUP BY 1, 2, 3),
    m AS (SELECT id, max(s / nullif(n - 1, 0)) FILTER (WHERE own = other) AS a,
        min(s / n) FILTER (WHERE own <> other) AS b FROM d GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0
        ELSE (b - a) / greatest(a, b) END), {digits}) AS silhouette, count(*) AS n FROM m"""
_SQUARE = """(a.measure - b.measure) * (a.measure - b.measure) + (a.temp - b.temp) * (a.temp - b.temp)
        + CAST((a.hour - b.hour) * (a.hour - b.hour) AS DOUBLE)"""


@query("silhouette_squared", f"WITH {_LABELLED}, {_ALL_PAIRS.format(distance=_SQUARE, digits=6)}")
def silhouette_squared(spark, d):
    """Squared distances over all rows, from sums per cluster."""
    return rounded(cu.silhouette(_labelled(spark, d), ["measure", "temp", "hour"], "cluster"), 6,
                   "silhouette")


@query("silhouette_euclid", f"WITH {_LABELLED}, {_ALL_PAIRS.format(distance=f'sqrt({_SQUARE})', digits=4)}")
def silhouette_euclid(spark, d):
    """Plain distances over all rows, from cells."""
    return rounded(sil.mean_distance_silhouette(
        _labelled(spark, d), ["measure", "temp", "hour"], "cluster"), 4, "silhouette")
