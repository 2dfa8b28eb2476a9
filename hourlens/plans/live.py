"""Streaming queries over the event feed, each run until its source is drained."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourlens.functions import columns as fc
from hourlens.operators import drift as dr
from hourlens.operators import models as md
from hourlens.operators import relational as rel
from hourlens.plans.learning import _condition_features, _conditions, _split
from hourlens.plans.registry import query
from hourlens.session import work_dir
from hourlens.sources import schemas, sinks, views
from hourlens.streaming import jobs


def _feed(spark, d):
    s = jobs.file_stream(spark, d, "events.parquet", schemas.EVENTS)
    return s.select("event_id", "ts", "user_id", F.col("event_type").alias("category"), "value",
                    F.get_json_object("props", "$.k").cast("int").alias("k"))


def _closed_feed(spark, d):
    """The feed and the marker that ends it, so the last windows are emitted as well."""
    feed = _feed(spark, d)
    closing = jobs.Closing(feed)
    return closing.attach(feed), closing


_REAL = "hour_ts < TIMESTAMP_NTZ '2900-01-01'"       # not the end marker


@query("stream_hourly", """SELECT hour_ts, count(*) AS n, round(avg(value), 6) AS mean FROM obs
    GROUP BY 1""")
def stream_hourly(spark, d):
    feed, closing = _closed_feed(spark, d)
    out = jobs.run_to_table(jobs.hourly_stats(feed), "stream-hourly", closing=closing)
    return out.where(_REAL).withColumn("mean", F.round("mean", 6))


@query("stream_dedup_best", "SELECT hour_ts, event_id, category, value, k FROM hourly")
def stream_dedup_best(spark, d):
    feed, closing = _closed_feed(spark, d)
    best = jobs.dedup_best(feed, fc.ordinal("category", views.SEVERITY, -1),
                           ["event_id"], ["event_id", "category", "value", "k"])
    return jobs.run_to_table(best, "stream-best", closing=closing).where(_REAL)


@query("stream_exact_dedup", """SELECT DISTINCT event_id, ts, user_id, category, value, k
    FROM obs_dirty""")
def stream_exact_dedup(spark, d):
    stage = work_dir(spark, "dirty-feed")
    sinks.write_stage(views.obs_dirty(spark, d).drop("hour_ts"), stage)
    feed = jobs.file_stream(spark, stage, "*.parquet", spark.read.parquet(stage).schema)
    cols = ["event_id", "ts", "user_id", "category", "value", "k"]
    return jobs.run_to_table(jobs.exact_dedup(feed, cols), "stream-dedup").select(*cols)


@query("stream_outages", """WITH kept AS (SELECT ts FROM obs WHERE NOT (day(ts) = 11
        OR (hour(ts) = 3 AND day(ts) IN (5, 17)))),
    g AS (SELECT ts, CASE WHEN ts - lag(ts) OVER (ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END
        AS new_run FROM kept),
    r AS (SELECT ts, sum(new_run) OVER (ORDER BY ts) AS run FROM g)
    SELECT 'all' AS series, min(ts) AS run_start, max(ts) AS run_last, count(*) AS n
    FROM r GROUP BY run""")
def stream_outages(spark, d):
    feed, closing = _closed_feed(spark, d)
    feed = feed.where(~((F.dayofmonth("ts") == 11)
                        | ((F.hour("ts") == 3) & F.dayofmonth("ts").isin(5, 17))))
    out = jobs.run_to_table(jobs.outages(feed, F.lit("all")), "stream-outages", closing=closing)
    return out.where(_REAL.replace("hour_ts", "run_start"))


_STREAM_DRIFT = """dlong AS (UNPIVOT (SELECT ts >= TIMESTAMP '2024-01-20' AS cur, value, CAST(k AS DOUBLE) AS k,
        CAST(hour(ts) AS DOUBLE) AS hour FROM obs) ON value, k, hour INTO NAME feature VALUE x),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(x,
        [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM dlong WHERE NOT cur GROUP BY 1),
bins AS (SELECT feature, i, e[i] AS lo, e[i + 1] AS hi, i = len(e) - 1 AS is_last
    FROM (SELECT feature, e, unnest(generate_series(1, len(e) - 1)) AS i FROM edges WHERE len(e) >= 3) z),
tot AS (SELECT count(*) FILTER (WHERE NOT cur) AS rn, count(*) FILTER (WHERE cur) AS cn FROM dlong
    WHERE feature = 'value'),
share AS (SELECT b.feature, b.i, greatest(count(x) FILTER (WHERE NOT cur) / max(rn), 1e-6) AS r,
    greatest(count(x) FILTER (WHERE cur) / max(cn), 1e-6) AS c FROM tot, bins b LEFT JOIN dlong d
    ON b.feature = d.feature AND x >= lo AND (x < hi OR (is_last AND x = hi)) GROUP BY 1, 2),
psi AS (SELECT e.feature, coalesce(sum((c - r) * ln(c / r)), 0) AS psi FROM edges e
    LEFT JOIN share s ON e.feature = s.feature GROUP BY 1)"""


@query("stream_drift", f"""WITH {_STREAM_DRIFT} SELECT feature, round(psi, 6) AS psi,
    CASE WHEN psi >= 0.25 THEN 'ALERT' WHEN psi >= 0.1 THEN 'WARN' ELSE 'PASS' END AS status FROM psi""")
def stream_drift(spark, d):
    """The current period as a feed of small files; after the last one its drift is that of the batch."""
    features = ["value", "k", "hour"]
    ref, cur = rel.split_at(views.obs(spark, d).withColumn("hour", F.hour("ts")),
                            datetime(2024, 1, 20))
    stage = work_dir(spark, "drift-feed")
    cur.repartition(4, "hour_ts").write.parquet(stage)
    feed = jobs.file_stream(spark, stage, "*.parquet", cur.schema, files_per_trigger=2)
    state = jobs.DriftState(ref, features, dr.reference_edges(ref, features))
    return jobs.drift_so_far(feed, state).withColumn("psi", F.round("psi", 6))


_LIMITS = {"temp_celsius": (-25.0, 50.0), "rain_1h": (0.0, 100.0)}


@query("stream_rejects", """SELECT event_id, CASE WHEN bad_rain AND bad_temp THEN 'rain_1h,temp_celsius'
        WHEN bad_rain THEN 'rain_1h' ELSE 'temp_celsius' END AS reasons
    FROM (SELECT event_id, NOT coalesce(rain_1h BETWEEN 0 AND 10, FALSE) AS bad_rain,
        NOT coalesce(temp - 273.15 BETWEEN -25 AND 50, FALSE) AS bad_temp FROM finput) z WHERE bad_rain OR bad_temp""")
def stream_rejects(spark, d):
    """What a feed of conditions turns away, with the reasons."""
    stage = work_dir(spark, "condition-feed")
    _conditions(spark, d).write.parquet(stage)
    feed = jobs.file_stream(spark, stage, "*.parquet", spark.read.parquet(stage).schema)
    checked = rel.check_bounds(feed, _LIMITS | {"rain_1h": (0.0, 10.0)}, {"weather": views.LEVELS})
    bad = checked.where(~F.col("is_valid")).select("event_id", F.array_join("reasons", ",").alias("reasons"))
    return jobs.run_to_table(bad, "stream-rejects")


@query("stream_score")
def stream_score(spark, d):
    train, _ = _split(spark, d, "measure")
    model = md.fit_linear(train, views.FEATURES, "measure")
    stage = work_dir(spark, "condition-feed")
    conditions = _conditions(spark, d)
    conditions.write.parquet(stage)
    feed = jobs.file_stream(spark, stage, "*.parquet", spark.read.parquet(stage).schema)
    good, bad = jobs.score(feed, model, _condition_features, ["event_id"],
                           _LIMITS, {"weather": views.LEVELS})
    scored = jobs.run_to_table(good, "stream-scored")
    rejected = jobs.run_to_table(bad, "stream-rejected")
    return (scored.select("event_id", "prediction", F.lit(None).cast("string").alias("reasons"))
            .unionByName(rejected.select("event_id", F.lit(None).cast("double")
                                         .alias("prediction"), "reasons")))
