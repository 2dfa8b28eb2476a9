"""Projections, filters, joins, set operations, sorts and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.operators import cleaning as cl
from hourlens.operators import features as fx
from hourlens.operators import recommend as rc
from hourlens.operators import relational as rel
from hourlens.operators import rules as ru
from hourlens.plans.registry import query
from hourlens.session import work_dir
from hourlens.sources import sinks, views


# --- projections and filters ------------------------------------------------
@query("project_cast", """SELECT event_id, CAST(floor(value) AS INTEGER) AS value_int,
    CAST(k AS DOUBLE) AS k_double, CAST(user_id AS VARCHAR) AS user_text,
    TRY_CAST(category AS INTEGER) AS bad_cast FROM obs""")
def project_cast(spark, d):
    return views.obs(spark, d).select(
        "event_id", F.floor("value").cast("int").alias("value_int"),
        F.col("k").cast("double").alias("k_double"), F.col("user_id").cast("string")
        .alias("user_text"), F.col("category").try_cast("int").alias("bad_cast"))


@query("sentinel_to_null", """SELECT event_id, nullif(tag, 'None') AS tag FROM obs_raw""")
def sentinel_to_null(spark, d):
    return views.obs_raw(spark, d).select("event_id", fc.sentinel_to_null("tag").alias("tag"))


@query("filter_range_year", """SELECT o_orderkey, ts, volume FROM daily
    WHERE year(ts) BETWEEN 1996 AND 1998""")
def filter_range_year(spark, d):
    return rel.in_years(views.daily(spark, d), "ts", 1996, 1998).select("o_orderkey", "ts",
                                                                        "volume")


@query("filter_in_list", "SELECT event_id, category FROM obs "
                         "WHERE category IN ('error', 'purchase')")
def filter_in_list(spark, d):
    return views.obs(spark, d).where(F.col("category").isin(views.SEVERE)).select("event_id",
                                                                                  "category")


@query("filter_not_null", "SELECT o_orderkey, ts, tag FROM daily_tagged WHERE tag IS NOT NULL")
def filter_not_null(spark, d):
    return views.daily_tagged(spark, d).where(F.col("tag").isNotNull()).select("o_orderkey", "ts",
                                                                               "tag")


@query("filter_threshold", "SELECT event_id, value, k FROM obs WHERE value > 60 AND k > 0")
def filter_threshold(spark, d):
    return views.obs(spark, d).where("value > 60 and k > 0").select("event_id", "value", "k")


@query("filter_day_type", """SELECT 'weekend' AS day_type, event_id FROM obs
    WHERE isodow(ts) >= 6 UNION ALL SELECT 'weekday', event_id FROM obs WHERE isodow(ts) < 6
    UNION ALL SELECT 'all', event_id FROM obs""")
def filter_day_type(spark, d):
    o = views.obs(spark, d)
    parts = [rel.by_day_type(o, t).select(F.lit(t).alias("day_type"), "event_id")
             for t in ("weekend", "weekday", "all")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("filter_hour_window", "SELECT event_id, ts FROM obs WHERE hour(ts) BETWEEN 6 AND 20")
def filter_hour_window(spark, d):
    return rel.hour_window(views.obs(spark, d), 6, 20).select("event_id", "ts")


@query("filter_time_split", """SELECT 'reference' AS period, count(*) AS n, max(ts) AS edge_ts
    FROM obs WHERE ts < TIMESTAMP '2024-01-20' UNION ALL
    SELECT 'current', count(*), min(ts) FROM obs WHERE ts >= TIMESTAMP '2024-01-20'""")
def filter_time_split(spark, d):
    before, after = rel.split_at(views.obs(spark, d), datetime(2024, 1, 20))
    return before.agg(F.lit("reference").alias("period"), F.count("*").alias("n"),
                      F.max("ts").alias("edge_ts")).unionByName(
        after.agg(F.lit("current").alias("period"), F.count("*").alias("n"),
                  F.min("ts").alias("edge_ts")))


@query("case_recode", """SELECT event_id, CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday'
    END AS day_type, CASE WHEN category IN ('view', 'click') THEN 'fair' ELSE 'adverse' END
    AS band FROM obs""")
def case_recode(spark, d):
    return views.obs(spark, d).select(
        "event_id", F.when(fc.weekend_flag("ts") == 1, "weekend").otherwise("weekday")
        .alias("day_type"), F.when(F.col("category").isin(views.FAIR), "fair")
        .otherwise("adverse").alias("band"))


@query("column_subset_drop", "SELECT k, value, event_id FROM obs")
def column_subset_drop(spark, d):
    return views.obs(spark, d).drop("ts", "hour_ts", "user_id", "category").select(
        "k", "value", "event_id")


@query("derived_unit", """SELECT event_id, round(temp - 273.15, 6) AS temp_celsius,
    round(temp - 273.15 + 273.15, 6) AS temp_back FROM finput""")
def derived_unit(spark, d):
    c = F.col("temp") - config.KELVIN_OFFSET
    return views.feature_input(spark, d).select(
        "event_id", F.round(c, 6).alias("temp_celsius"),
        F.round(c + config.KELVIN_OFFSET, 6).alias("temp_back"))


@query("dropna_subset", "SELECT event_id, value FROM obs_dirty WHERE value IS NOT NULL")
def dropna_subset(spark, d):
    return views.obs_dirty(spark, d).dropna(subset=["value"]).select("event_id", "value")


@query("input_bounds_check", """SELECT event_id, list_aggregate(list_sort(list_filter([
        CASE WHEN NOT coalesce(value BETWEEN 0 AND 100, false) THEN 'value' END,
        CASE WHEN NOT coalesce(k BETWEEN 5 AND 95, false) THEN 'k' END,
        CASE WHEN NOT coalesce(category IN ('click', 'error', 'signup', 'view'), false)
             THEN 'category' END], lambda x: x IS NOT NULL)), 'string_agg', ',') AS reasons,
    coalesce(value BETWEEN 0 AND 100, false) AND coalesce(k BETWEEN 5 AND 95, false)
        AND coalesce(category IN ('click', 'error', 'signup', 'view'), false) AS is_valid
    FROM obs_dirty""")
def input_bounds_check(spark, d):
    out = rel.check_bounds(views.obs_dirty(spark, d), {"value": (0, 100), "k": (5, 95)},
                           {"category": ["click", "error", "signup", "view"]})
    return out.select("event_id", F.when(F.size("reasons") > 0, F.array_join("reasons", ","))
                      .alias("reasons"), "is_valid")


# --- joins and look-ups -----------------------------------------------------
@query("join_dim_back", """SELECT d.o_orderkey, d.ts, d.volume, t.tag, t.tag_date,
    CAST(t.year AS INTEGER) AS year FROM daily d JOIN (SELECT DISTINCT tag,
        CAST(ts AS DATE) AS tag_date, year(ts) AS year FROM daily_tagged
        WHERE tag IN ('new_year', 'labor') AND year(ts) BETWEEN 1996 AND 2000) t
    ON CAST(d.ts AS DATE) = t.tag_date""")
def join_dim_back(spark, d):
    dim = rel.tag_dates(rel.in_years(views.daily_tagged(spark, d), "ts", 1996, 2000)
                        .where(F.col("tag").isin("new_year", "labor")))
    return rel.join_dim_back(views.daily(spark, d), dim).select(
        "o_orderkey", "ts", "volume", "tag", "tag_date", "year")


@query("join_dim_pruned", """SELECT o.event_id, o.ts, o.value, t.tag, CAST(o.ts AS DATE) AS day
    FROM obs o JOIN (SELECT CAST(ts AS DATE) AS day_, max(tag) AS tag FROM obs_parsed
        WHERE tag IS NOT NULL GROUP BY 1) t ON CAST(o.ts AS DATE) = t.day_""")
def join_dim_pruned(spark, d):
    """Tagged dates of a stage that is partitioned by date."""
    rows = views.obs(spark, d).select("event_id", "ts", "value", F.to_date("ts").alias("day"))
    stage = spark.read.parquet(sinks.write_stage(rows.repartition("day"), work_dir(spark, "by-day"), ["day"]))
    raw = views.obs_raw(spark, d).where("tag <> 'None'")
    tags = cl.parse_drop(raw, "date_time").select(F.to_date("ts").alias("tag_date"), "tag").distinct()
    dim = spark.read.parquet(sinks.write_stage(tags, work_dir(spark, "tag-dates")))
    return rel.join_tagged_dates(stage, dim, "day")


@query("propagate_sparse_tag", """SELECT d.o_orderkey, d.ts, t.tag,
    CAST(t.tag IS NOT NULL AS INTEGER) AS is_tag FROM daily d LEFT JOIN (
        SELECT CAST(ts AS DATE) AS day_, max(tag) AS tag FROM daily_tagged
        WHERE tag IS NOT NULL GROUP BY 1) t ON CAST(d.ts AS DATE) = t.day_""")
def propagate_sparse_tag(spark, d):
    return rel.propagate_tag(views.daily_tagged(spark, d)).select("o_orderkey", "ts", "tag",
                                                                  "is_tag")


@query("impute_by_group_lookup", """SELECT o_orderkey, round(CASE WHEN volume < 2000
        OR volume > 450000 THEN med ELSE volume END, 4) AS volume FROM daily
    LEFT JOIN (SELECT month(ts) AS mo, median(volume) AS med FROM daily
        WHERE volume BETWEEN 2000 AND 450000 GROUP BY 1) ON month(ts) = mo""")
def impute_by_group_lookup(spark, d):
    out = cl.impute_range(views.daily(spark, d), {"volume": (2000.0, 450000.0)})
    return out.select("o_orderkey", F.round("volume", 4).alias("volume"))


@query("map_ordinal", """SELECT event_id, CAST(CASE category WHEN 'error' THEN 4
        WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 WHEN 'click' THEN 1 ELSE -1 END AS INTEGER)
        AS rank_dedup, CAST(CASE category WHEN 'error' THEN 4 WHEN 'purchase' THEN 3 ELSE 0 END
        AS INTEGER) AS rank_cluster FROM obs""")
def map_ordinal(spark, d):
    known = {c: r for c, r in views.SEVERITY.items() if c != "view"}
    few = {c: r for c, r in views.SEVERITY.items() if r >= 3}
    return views.obs(spark, d).select("event_id",
                                      fc.ordinal("category", known, -1).alias("rank_dedup"),
                                      fc.ordinal("category", few, 0).alias("rank_cluster"))


@query("concat_columns", """SELECT event_id, category,
    CAST(category = 'click' AS INTEGER) AS is_click, CAST(category = 'error' AS INTEGER)
    AS is_error, k + 1 AS k_next FROM obs""")
def concat_columns(spark, d):
    return views.obs(spark, d).withColumns({
        "is_click": (F.col("category") == "click").cast("int"),
        "is_error": (F.col("category") == "error").cast("int"),
        "k_next": F.col("k") + 1}).select("event_id", "category", "is_click", "is_error", "k_next")


@query("nearest_time_lookup", """SELECT s.h AS probe_hour, arg_min(g.hour_ts, struct_pack(
        gap := abs(date_diff('hour', s.h, g.hour_ts)), t := g.hour_ts)) AS nearest_hour,
    min(abs(date_diff('hour', s.h, g.hour_ts))) AS gap_hours,
    min(abs(date_diff('hour', s.h, g.hour_ts))) = 0 AS is_exact
    FROM (SELECT unnest(generate_series((SELECT min(hour_ts) FROM hourly),
        (SELECT max(hour_ts) FROM hourly), INTERVAL 1 HOUR)) AS h) s, gappy g GROUP BY s.h""")
def nearest_time_lookup(spark, d):
    ends = views.obs(spark, d).agg(F.min("hour_ts").alias("lo"), F.max("hour_ts").alias("hi"))
    probes = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour")))
                         .alias("probe_ts"))
    hours = views.obs(spark, d).select("hour_ts").where(views.no_gap()).distinct()
    return rel.nearest(hours, probes, "hour_ts")


@query("nearest_time_one", """SELECT hour_ts, event_id, category, value,
    abs(date_diff('second', TIMESTAMP '2024-01-11 08:00:00', hour_ts)) AS gap_seconds,
    hour_ts = TIMESTAMP '2024-01-11 08:00:00' AS is_exact FROM gappy
    ORDER BY gap_seconds, hour_ts LIMIT 1""")
def nearest_time_one(spark, d):
    return rel.nearest_to(views.hourly_gappy(spark, d), datetime(2024, 1, 11, 8, 20),
                          "hour_ts").drop("k", "sev")


@query("attach_global_stats", """SELECT o_orderkey, round(volume - m, 4) AS from_mean,
    round(volume / hi, 8) AS of_max, volume <= q1 AS in_low_quarter FROM daily,
    (SELECT avg(volume) AS m, max(volume) AS hi, quantile_cont(volume, 0.25) AS q1 FROM daily)""")
def attach_global_stats(spark, d):
    from hourlens.functions.quantiles import quantiles

    df = views.daily(spark, d)
    s = fc.scalar(df.agg(F.avg("volume").alias("m"), F.max("volume").alias("hi")))
    q1 = fc.scalar(quantiles(df, "volume", [0.25]).select("q"))["q"][0]
    return df.select("o_orderkey", F.round(F.col("volume") - s["m"], 4).alias("from_mean"),
                     F.round(fc.ratio(F.col("volume"), s["hi"]), 8).alias("of_max"),
                     (F.col("volume") <= q1).alias("in_low_quarter"))


_ASKED = ["click", "hail", "storm", "view"]


@query("unknown_members", """SELECT v AS category FROM (VALUES ('click'), ('hail'), ('storm'),
    ('view')) t(v) WHERE v NOT IN (SELECT category FROM obs)""")
def unknown_members(spark, d):
    return rel.unknown_members(views.obs(spark, d), "category", _ASKED)


# --- set operations ---------------------------------------------------------
@query("set_difference", """SELECT 'late_only' AS side, user_id FROM (SELECT user_id FROM obs
        WHERE ts >= TIMESTAMP '2024-01-29' EXCEPT SELECT user_id FROM obs
        WHERE ts < TIMESTAMP '2024-01-03')
    UNION ALL SELECT 'early_only', user_id FROM (SELECT user_id FROM obs
        WHERE ts < TIMESTAMP '2024-01-03' EXCEPT SELECT user_id FROM obs
        WHERE ts >= TIMESTAMP '2024-01-29')""")
def set_difference(spark, d):
    o = views.obs(spark, d)
    early, _ = rel.split_at(o, datetime(2024, 1, 3))
    _, late = rel.split_at(o, datetime(2024, 1, 29))
    early, late = early.select("user_id"), late.select("user_id")
    return late.subtract(early).select(F.lit("late_only").alias("side"), "user_id").unionByName(
        early.subtract(late).select(F.lit("early_only").alias("side"), "user_id"))


@query("set_distinct_members", "SELECT DISTINCT category FROM obs")
def set_distinct_members(spark, d):
    return views.obs(spark, d).select("category").distinct()


# --- sorts and top-k --------------------------------------------------------
@query("order_by_keys", """SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM obs
    GROUP BY 1 ORDER BY n DESC, user_id""")
def order_by_keys(spark, d):
    return views.obs(spark, d).groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("ts").alias("last_ts")).orderBy(F.desc("n"), "user_id")


@query("topk_busiest", """WITH p AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS mean,
        count(value) AS n FROM obs WHERE isodow(ts) < 6 GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY mean DESC, hour) AS rb,
        row_number() OVER (ORDER BY mean, hour) AS rq, max(mean) OVER () / min(mean) OVER ()
        AS ratio FROM p)
    SELECT 'busiest' AS kind, CAST(rb AS INTEGER) AS rank, hour, round(mean, 6) AS mean, n,
        round(ratio, 6) AS peak_to_trough FROM r WHERE rb <= 3
    UNION ALL SELECT 'quietest', CAST(rq AS INTEGER), hour, round(mean, 6), n, round(ratio, 6)
    FROM r WHERE rq <= 3""")
def topk_busiest(spark, d):
    out = rc.top_hours(views.obs(spark, d), "weekday", 3, "value")
    return out.withColumns({"mean": F.round("mean", 6),
                            "peak_to_trough": F.round("peak_to_trough", 6)})


@query("topk_quiet_window", """WITH b AS (SELECT hour(ts) AS h, value FROM obs
        WHERE isodow(ts) < 6),
    p AS (SELECT CAST(h AS INTEGER) AS hour, avg(value) AS mean FROM b
          WHERE h BETWEEN 6 AND 20 GROUP BY 1),
    w AS (SELECT hour, mean FROM p ORDER BY mean DESC, hour DESC LIMIT 1),
    o AS (SELECT avg(value) AS m FROM b)
    SELECT CAST(row_number() OVER (ORDER BY p.mean, p.hour) AS INTEGER) AS rank, p.hour,
        round(p.mean, 6) AS mean, round(100 * (p.mean - m) / m, 6) AS relative_pct,
        w.hour AS busiest_hour, round(w.mean, 6) AS busiest_mean FROM p, w, o
    ORDER BY p.mean, p.hour LIMIT 3""")
def topk_quiet_window(spark, d):
    out = rc.advise(views.obs(spark, d), "weekday", 6, 20, 3, "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "relative_pct", "busiest_mean")})


@query("arg_extreme", """WITH p AS (SELECT CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
        CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS mean FROM obs GROUP BY 1, 2)
    SELECT is_weekend, arg_max(hour, struct_pack(m := mean, h := -hour)) AS peak_hour,
        round(max(mean), 6) AS peak_mean,
        arg_min(hour, struct_pack(m := mean, h := hour)) AS trough_hour,
        round(min(mean), 6) AS trough_mean FROM p GROUP BY 1""")
def arg_extreme(spark, d):
    out = rc.extreme_hours(views.obs(spark, d), "value")
    return out.withColumns({c: F.round(c, 6) for c in ("peak_mean", "trough_mean")})


@query("sample_rows", """SELECT event_id, category, value FROM obs
    ORDER BY md5(concat(CAST(event_id AS VARCHAR), ':42')), event_id LIMIT 5000""")
def sample_rows(spark, d):
    return rel.sample_hash(views.obs(spark, d).select("event_id", "category", "value"),
                           "event_id", 5000)


# --- scalar functions -------------------------------------------------------
@query("date_parts", """SELECT o_orderkey, CAST(year(ts) AS INTEGER) AS year,
    strftime(ts, '%Y-%m') AS month_text, CAST(ts AS DATE) AS date,
    CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour FROM daily""")
def date_parts(spark, d):
    return views.daily(spark, d).select(
        "o_orderkey", F.year("ts").alias("year"), F.date_format("ts", "yyyy-MM")
        .alias("month_text"), F.to_date("ts").alias("date"), F.month("ts").alias("month"),
        F.hour("ts").alias("hour"))


@query("day_of_week_mon0", """SELECT o_orderkey, CAST(isodow(ts) - 1 AS INTEGER) AS dow,
    CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM daily""")
def day_of_week_mon0(spark, d):
    return views.daily(spark, d).select("o_orderkey", fc.day_of_week("ts").alias("dow"),
                                        fc.weekend_flag("ts").alias("is_weekend"))


@query("parse_timestamp", """SELECT event_id, TRY_CAST(date_time AS TIMESTAMP) AS ts
    FROM obs_raw""")
def parse_timestamp(spark, d):
    return views.obs_raw(spark, d).select("event_id", cl.parse_timestamp("date_time").alias("ts"))


@query("floor_hour", "SELECT event_id, date_trunc('hour', ts) AS hour_ts FROM events")
def floor_hour(spark, d):
    return views.table(spark, d, "events").select("event_id", fc.floor_hour("ts").alias("hour_ts"))


@query("abs_time_diff", """SELECT event_id,
    abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) AS gap_micros FROM events""")
def abs_time_diff(spark, d):
    mark = fc.epoch_micros(F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return views.table(spark, d, "events").select(
        "event_id", F.abs(fc.epoch_micros("ts") - mark).alias("gap_micros"))


@query("format_time", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS stamp,
    dayname(ts) AS weekday_name FROM events""")
def format_time(spark, d):
    return views.table(spark, d, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("stamp"),
        F.date_format("ts", "EEEE").alias("weekday_name"))


@query("cyclic_encode", """SELECT event_id, round(hour_sin, 6) + 0.0 AS hour_sin,
    round(hour_cos, 6) + 0.0 AS hour_cos, round(dow_sin, 6) + 0.0 AS dow_sin,
    round(dow_cos, 6) + 0.0 AS dow_cos FROM ftime""")
def cyclic_encode(spark, d):
    df = fx.add_time(views.obs(spark, d))
    return df.select("event_id", *[(F.round(c, 6) + 0.0).alias(c)
                                   for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")])


@query("trim_text", """SELECT event_id, trim(category) AS category,
    category <> trim(category) AS changed FROM obs_dirty""")
def trim_text(spark, d):
    return views.obs_dirty(spark, d).select(
        "event_id", fc.strip_text("category").alias("category"),
        (F.col("category") != fc.strip_text("category")).alias("changed"))


@query("string_lower_replace_concat", """SELECT o_orderkey,
    concat(lower(replace(category, '-', ' is ')), ' / ', CAST(o_custkey AS VARCHAR)) AS text,
    starts_with(category, '1-') AS is_first FROM daily""")
def string_lower_replace_concat(spark, d):
    return views.daily(spark, d).select(
        "o_orderkey", F.format_string("%s / %d", F.lower(F.replace(
            F.col("category"), F.lit("-"), F.lit(" is "))), F.col("o_custkey")).alias("text"),
        F.col("category").startswith("1-").alias("is_first"))


@query("round_n", """SELECT event_id, round(value, 0) AS r0, round(value / 7.1, 1) AS r1,
    round(value / 7.1, 2) AS r2, round(value / 7.1, 3) AS r3, round(value / 7.1, 4) AS r4 FROM obs""")
def round_n(spark, d):
    part = F.col("value") / 7.1
    return views.obs(spark, d).select("event_id", F.round("value", 0).alias("r0"), *[
        F.round(part, i).alias(f"r{i}") for i in range(1, 5)])


@query("nullif_coalesce_fill", """SELECT event_id, nullif(trim(category), 'view') AS category,
    coalesce(value, -1) AS value FROM obs_dirty""")
def nullif_coalesce_fill(spark, d):
    return views.obs_dirty(spark, d).select(
        "event_id", F.nullif(fc.strip_text("category"), F.lit("view")).alias("category"),
        "value").na.fill({"value": -1.0})


@query("cut_labels", """SELECT event_id, CASE WHEN hour <= 5 THEN 'night'
    WHEN hour <= 9 THEN 'morning_peak' WHEN hour <= 15 THEN 'midday'
    WHEN hour <= 19 THEN 'evening_peak' ELSE 'late_evening' END AS time_band,
    CASE WHEN k - 30 <= -40 THEN NULL WHEN k - 30 <= 0 THEN 'freezing'
         WHEN k - 30 <= 15 THEN 'cool' WHEN k - 30 <= 50 THEN 'warm' END AS temp_band
    FROM ftime""")
def cut_labels(spark, d):
    return views.obs(spark, d).select(
        "event_id", fc.cut_labels(F.hour("ts"), *config.TIME_BANDS).alias("time_band"),
        fc.cut_labels(F.col("k") - 30, *config.TEMP_BANDS).alias("temp_band"))


@query("band_fixed", """SELECT o_orderkey, CASE WHEN volume / 50 < 4500 THEN 'Low'
    WHEN volume / 50 <= 5500 THEN 'Medium' ELSE 'High' END AS band FROM daily""")
def band_fixed(spark, d):
    return views.daily(spark, d).select("o_orderkey", fc.band(
        F.col("volume") / 50, *config.VOLUME_BANDS).alias("band"))


@query("math_basic", """SELECT event_id, round(sqrt(value), 6) AS root, round(ln(value + 1), 6)
    AS log1, abs(k - 50) AS off_centre, greatest(value, 1.0) AS clipped,
    CASE WHEN k = 0 THEN NULL ELSE value / k END AS guarded FROM obs""")
def math_basic(spark, d):
    v = F.col("value")
    return views.obs(spark, d).select(
        "event_id", F.round(F.sqrt(v), 6).alias("root"), F.round(F.ln(v + 1), 6).alias("log1"),
        F.abs(F.col("k") - 50).alias("off_centre"), F.greatest(v, F.lit(1.0)).alias("clipped"),
        fc.ratio("value", "k").alias("guarded"))


@query("typeof_col", """SELECT lower(typeof(value)) AS value_type, lower(typeof(event_id))
    AS id_type, count(*) AS n FROM events GROUP BY 1, 2""")
def typeof_col(spark, d):
    return views.table(spark, d, "events").groupBy(
        F.typeof("value").alias("value_type"), F.typeof("event_id").alias("id_type")).agg(
        F.count("*").alias("n"))


@query("array_items", """SELECT event_id, concat_ws('|', concat('cat=', category),
        concat('day=', CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday' END)) AS items,
    category = 'error' AND isodow(ts) >= 6 AS covered FROM obs""")
def array_items(spark, d):
    df = views.obs(spark, d).select(
        "event_id", F.col("category").alias("cat"),
        F.when(fc.weekend_flag("ts") == 1, "weekend").otherwise("weekday").alias("day"))
    items = ru.items_array(["cat", "day"])
    rule = F.array(F.lit("cat=error"), F.lit("day=weekend"))
    return df.select("event_id", F.array_join(items, "|").alias("items"),
                     ru.covers(rule, items).alias("covered"))


@query("status_band", """WITH s AS (SELECT category, avg(abs(prediction - y)) / 100 AS v
        FROM preds GROUP BY 1), b AS (SELECT category, round(v, 6) AS v,
        CASE WHEN v >= 0.39 THEN 'ALERT' WHEN v >= 0.37 THEN 'WARN' ELSE 'PASS' END AS status
        FROM s)
    SELECT *, (SELECT CASE max(CASE status WHEN 'ALERT' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END)
        WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARN' ELSE 'PASS' END FROM b) AS overall FROM b""")
def status_band(spark, d):
    from hourlens.plans.derived import predictions

    s = predictions(spark, d).groupBy("category").agg(
        (F.avg(F.abs(F.col("prediction") - F.col("y"))) / 100).alias("v"))
    b = s.withColumn("status", fc.status_band("v", 0.37, 0.39))
    worst = fc.scalar(b.agg(F.max(fc.status_rank("status")).alias("r")))["r"]
    return b.select("category", F.round("v", 6).alias("v"), "status",
                    fc.status_name(worst).alias("overall"))


@query("json_nested", """SELECT category, count(*) AS n, round(avg(value), 4) AS mean,
    CAST(min(k) AS INTEGER) AS lo FROM obs GROUP BY 1""")
def json_nested(spark, d):
    doc = views.obs(spark, d).groupBy("category").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("k").alias("lo"))
    text = doc.select("category", F.to_json(F.struct(
        F.struct("n", F.round("mean", 4).alias("mean")).alias("stats"),
        F.map_from_arrays(F.array(F.lit("lo")), F.array("lo")).alias("bounds"))).alias("doc"))
    pick = lambda path, kind: F.get_json_object("doc", path).cast(kind)
    return text.select("category", pick("$.stats.n", "bigint").alias("n"),
                       pick("$.stats.mean", "double").alias("mean"),
                       pick("$.bounds.lo", "int").alias("lo"))
