"""Scans, sinks, schema checks and audits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlens.functions import columns as fc
from hourlens.operators import aggregates as ag
from hourlens.operators import cleaning as cl
from hourlens.operators import evaluation as ev
from hourlens.operators import models as md
from hourlens.plans.derived import CLEAN, predictions, scores
from hourlens.plans.registry import query
from hourlens.session import work_dir
from hourlens.sources import readers, sinks, views


def _events_csv(spark, d, broken_every: int | None = None) -> str:
    """Events as headered CSV; with ``broken_every``, a line that does not fit the types for every
    so many events."""
    path = work_dir(spark, "events-csv")
    names = ["event_id", "ts", "user_id", "event_type", "value"]
    rows = views.table(spark, d, "events").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).select(
        *[F.col(c).cast("string") for c in names])
    if broken_every:
        bad = rows.where(F.col("event_id").cast("long") % broken_every == 0).select(
            F.concat(F.lit("broken "), "event_id").alias("event_id"),
            *[F.lit(None).cast("string").alias(c) for c in names[1:]])
        rows = rows.unionByName(bad)
    return sinks.write_stage(rows, path, fmt="csv")


@query("scan_csv_typed", f"""SELECT event_id, ts, user_id, event_type, value,
        CAST(NULL AS VARCHAR) AS {readers.CORRUPT} FROM events
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, concat('broken ', event_id, ',,,,') FROM events
    WHERE event_id % 500 = 0""")
def scan_csv_typed(spark, d):
    schema = T.StructType(views.table(spark, d, "events").schema.fields[:5])
    return readers.scan_csv(spark, _events_csv(spark, d, 500), schema)


@query("scan_text_then_cast", """SELECT event_id, ts, user_id,
    nullif(event_type, 'view') AS event_type, value FROM events""")
def scan_text_then_cast(spark, d):
    typed = T.StructType(views.table(spark, d, "events").schema.fields[:5])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in typed.fields])
    raw = readers.scan_csv(spark, _events_csv(spark, d), text, keep_corrupt=False)
    loaded = spark.table(sinks.create_table(raw, "events_text"))
    return spark.table(sinks.create_table(
        readers.cast_text(loaded, typed, {"event_type": "view"}), "events_typed"))


@query("cast_failures", """SELECT 'event_id' AS "column", 0::BIGINT AS n_failed FROM (SELECT 1)
    UNION ALL SELECT 'ts', count(*) FILTER (WHERE TRY_CAST(date_time AS TIMESTAMP) IS NULL)
    FROM obs_raw""")
def cast_failures(spark, d):
    wanted = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType())])
    raw = views.obs_raw(spark, d).select(F.col("event_id").cast("string"),
                                         F.col("date_time").alias("ts"))
    return readers.cast_failures(raw, wanted)


@query("scan_table", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_table(spark, d):
    return readers.scan_table(spark, f"{d}/events.parquet")


@query("scan_stage", "SELECT hour_ts, event_id, category, value, k FROM hourly")
def scan_stage(spark, d):
    path = sinks.write_stage(views.hourly(spark, d).drop("sev"), work_dir(spark, "hourly"))
    return spark.read.parquet(path)


@query("sink_table", """SELECT o_orderkey, ts, volume, category,
    CAST(year(ts) AS INTEGER) AS year FROM daily""")
def sink_table(spark, d):
    df = views.daily(spark, d).select("o_orderkey", "ts", "volume", "category",
                                      F.year("ts").alias("year"))
    return spark.read.parquet(sinks.write_stage(df, work_dir(spark, "daily"), ["year"]))


@query("sink_csv_topn", """SELECT o_orderkey, volume, category FROM daily
    ORDER BY volume DESC, o_orderkey LIMIT 25""")
def sink_csv_topn(spark, d):
    df = views.daily(spark, d).select("o_orderkey", "volume", "category")
    path = sinks.write_top_csv(df, work_dir(spark, "top"), [F.desc("volume"), F.col("o_orderkey")])
    return readers.scan_csv(spark, path, df.schema, keep_corrupt=False)


@query("sink_json_doc", """SELECT category, count(*) AS n, round(avg(volume), 2) AS mean_volume
    FROM daily GROUP BY category""")
def sink_json_doc(spark, d):
    prof = ag.category_profile(views.daily(spark, d), "category", "volume")
    doc = prof.select("category", F.struct("n", F.round("mean", 2).alias("mean_volume"))
                      .alias("stats"))
    path = sinks.write_json(doc, work_dir(spark, "doc"))
    return spark.read.schema(doc.schema).json(path).select(
        "category", F.col("stats.n").alias("n"), F.col("stats.mean_volume").alias("mean_volume"))


EXPECTED = ["event_id", "ts", "user_id", "event_type", "value", "severity"]


@query("schema_check", """SELECT w.name AS "column", CASE WHEN h.column_name IS NULL
        THEN 'missing' ELSE 'ok' END AS status, (SELECT count(*) FROM events) AS n_rows
    FROM (VALUES ('event_id'), ('ts'), ('user_id'), ('event_type'), ('value'), ('severity'))
        w(name) LEFT JOIN (SELECT column_name FROM (DESCRIBE events)) h ON w.name = h.column_name
    UNION ALL SELECT column_name, 'extra', (SELECT count(*) FROM events)
    FROM (DESCRIBE events) WHERE column_name NOT IN
        ('event_id', 'ts', 'user_id', 'event_type', 'value', 'severity')""")
def schema_check(spark, d):
    df = views.table(spark, d, "events")
    n = fc.scalar(df.agg(F.count("*").alias("n")))["n"]
    return readers.schema_check(df, EXPECTED).withColumn("n_rows", n)


@query("feature_columns_check", "SELECT count(*) AS n_rows, 23 AS n_features FROM feat")
def feature_columns_check(spark, d):
    df = readers.require_columns(views.feat(spark, d), views.FEATURES)
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_features",
                                                           F.lit(len(views.FEATURES)))


@query("load_verify", """SELECT count(*) AS row_count, min(ts) AS first_ts, max(ts) AS last_ts,
    lower(any_value(typeof(value))) AS value_type, lower(any_value(typeof(event_id)))
    AS event_id_type FROM events""")
def load_verify(spark, d):
    return readers.load_verify(views.table(spark, d, "events"), "ts", ["value", "event_id"])


@query("table_head", """SELECT event_id, ts, user_id, event_type, value FROM events
    ORDER BY ts, event_id LIMIT 5""")
def table_head(spark, d):
    return readers.head(views.table(spark, d, "events").drop("props"), ["ts", "event_id"])


@query("model_store", "SELECT event_id, TRUE AS same_after_reload FROM events")
def model_store(spark, d):
    """Does a stored and reloaded model score every row as the fitted one does?"""
    from pyspark.ml import PipelineModel

    feat = views.feat(spark, d)
    path = work_dir(spark, "model")
    fitted = md.fit_linear(feat, views.FEATURES, "measure")
    fitted.write().overwrite().save(path)
    once = md.score_regression(fitted, feat, ["event_id", *views.FEATURES])
    again = md.score_regression(PipelineModel.load(path), once.withColumnRenamed("prediction", "first"),
                                ["event_id", "first"])
    return again.select("event_id", (F.col("first") == F.col("prediction")).alias("same_after_reload"))


_RUNS = """SELECT 'risk' AS experiment, 'run_1' AS run, 'k_shifted' AS model, 'metric' AS kind,
    'accuracy' AS name, round(avg(CAST(y = prediction AS INTEGER)), 6) AS value FROM scores
    UNION ALL SELECT 'volume', 'run_1', 'k_line', 'metric', 'mae',
        round(avg(abs(prediction - y)), 6) FROM preds
    UNION ALL SELECT 'volume', 'run_1', 'k_line', 'metric', 'rmse',
        round(sqrt(avg((prediction - y) * (prediction - y))), 6) FROM preds"""


def _ledger(spark, d) -> str:
    path = work_dir(spark, "ledger")
    acc = ev.precision_recall(ev.confusion(scores(spark, d))).withColumn("model",
                                                                         F.lit("k_shifted"))
    sinks.record_run(sinks.ledger_rows(acc, "risk", "run_1", "model", ["accuracy"]), path)
    reg = ev.regression_metrics(predictions(spark, d)).withColumn("model", F.lit("k_line"))
    for _ in range(2):                  # a job that is retried records its run once
        sinks.record_run(sinks.ledger_rows(reg, "volume", "run_1", "model", ["mae", "rmse"]), path)
    return path


@query("run_ledger", _RUNS)
def run_ledger(spark, d):
    return sinks.read_ledger(spark, _ledger(spark, d)).withColumn("value", F.round("value", 6))


@query("ledger_best_run", f"""SELECT experiment, run, model, value FROM ({_RUNS}) r
    WHERE name = 'accuracy'""")
def ledger_best_run(spark, d):
    return sinks.best_run(sinks.read_ledger(spark, _ledger(spark, d)), "accuracy") \
        .withColumn("value", F.round("value", 6))


@query("cleaning_audit", """WITH raw2 AS (SELECT *, TRY_CAST(date_time AS TIMESTAMP) AS pts,
        nullif(tag, 'None') AS tag2 FROM obs_raw),
    uniq AS (SELECT ts, event_id, user_id, category, value, k, tag, is_tag, count(*) AS c
             FROM obs_tagged GROUP BY ALL)
    SELECT 'parse' AS step, 'timestamp could not be parsed' AS reason,
        count(*) FILTER (WHERE pts IS NULL) AS rows_affected FROM raw2
    UNION ALL SELECT 'standardise', 'blanks around category',
        count(*) FILTER (WHERE category <> trim(category)) FROM raw2 WHERE pts IS NOT NULL
    UNION ALL SELECT 'standardise', 'blanks around tag', 0 FROM (SELECT 1)
    UNION ALL SELECT 'standardise', 'tag spread over tagged dates',
        (SELECT count(tag) FROM obs_tagged) - (SELECT count(tag) FROM obs_parsed)
    UNION ALL SELECT 'dedup', 'identical rows', CAST(sum(c) - count(*) AS BIGINT) FROM uniq
    UNION ALL SELECT 'dedup', 'repeated timestamps', count(*) - count(DISTINCT ts) FROM uniq
    UNION ALL SELECT 'impute', 'value out of range', count(*) FILTER (WHERE value > 1000)
        FROM obs_best
    UNION ALL SELECT 'impute', 'value of zero retained', count(*) FILTER (WHERE value = 0)
        FROM obs_best
    UNION ALL SELECT 'impute', 'k of zero retained', count(*) FILTER (WHERE k = 0) FROM obs_best
    UNION ALL SELECT 'fill', 'value missing', count(*) - count(value) FROM obs_best
    UNION ALL SELECT 'fill', 'k missing', count(*) - count(k) FROM obs_best
    UNION ALL SELECT 'fill', 'category missing', count(*) - count(category) FROM obs_best
    UNION ALL SELECT 'output', 'rows kept', count(*) FROM obs_best""")
def cleaning_audit(spark, d):
    return cl.audit(views.obs_raw(spark, d), CLEAN)
