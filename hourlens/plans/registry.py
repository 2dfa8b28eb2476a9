"""Query registry and the shared views of the check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourlens.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

_SEV = ("CASE category WHEN 'error' THEN 4 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 "
        "WHEN 'click' THEN 1 WHEN 'view' THEN 0 ELSE -1 END")


def _slice(tag: str) -> str:
    return f"substr(md5(concat('{tag}', CAST(event_id AS VARCHAR))), 1, 2)"


# Views in dependency order; a check names the ones it needs simply by using them.
VIEWS: dict[str, str] = {
    "obs": """SELECT event_id, date_trunc('hour', ts) AS hour_ts, ts, user_id,
        event_type AS category, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "dirty_base": f"""SELECT event_id, hour_ts, ts, user_id,
        CASE WHEN {_slice('p')} < '08' THEN concat('  ', category, ' ') ELSE category END
            AS category,
        CASE WHEN {_slice('x')} < '04' THEN 9999.0 WHEN {_slice('n')} < '04' THEN NULL
             ELSE value END AS value, k FROM obs""",
    "obs_dirty": f"""SELECT * FROM dirty_base
        UNION ALL SELECT * FROM dirty_base WHERE {_slice('d')} < '03'""",
    "obs_raw": f"""SELECT CASE WHEN {_slice('t')} < '02'
            THEN concat('?', strftime(hour_ts, '%Y-%m-%d %H:%M:%S'))
            ELSE strftime(hour_ts, '%Y-%m-%d %H:%M:%S') END AS date_time,
        event_id, user_id, category, value, k,
        CASE WHEN hour_ts = TIMESTAMP '2024-01-01 00:00:00' THEN 'new_year'
             WHEN hour_ts = TIMESTAMP '2024-01-15 00:00:00' THEN 'mid_month'
             ELSE 'None' END AS tag FROM obs_dirty""",
    "obs_parsed": """SELECT TRY_CAST(date_time AS TIMESTAMP) AS ts, event_id, user_id,
        trim(category) AS category, value, k, nullif(tag, 'None') AS tag FROM obs_raw
        WHERE TRY_CAST(date_time AS TIMESTAMP) IS NOT NULL""",
    "obs_tagged": """SELECT p.ts, event_id, user_id, category, value, k, t.tag,
        CAST(t.tag IS NOT NULL AS INTEGER) AS is_tag FROM obs_parsed p
        LEFT JOIN (SELECT CAST(ts AS DATE) AS d, max(tag) AS tag FROM obs_parsed
                   WHERE tag IS NOT NULL GROUP BY 1) t ON CAST(p.ts AS DATE) = t.d""",
    "obs_best": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY ts ORDER BY {_SEV} DESC, event_id) AS rn FROM obs_tagged) z
        WHERE rn = 1""",
    "obs_fixed": """SELECT b.ts, event_id, user_id, category, CASE WHEN value > 1000 THEN m.med
            ELSE value END AS value, k, tag, is_tag FROM obs_best b
        LEFT JOIN (SELECT month(ts) AS mo, median(value) AS med FROM obs_best
                   WHERE NOT coalesce(value > 1000, false) GROUP BY 1) m ON month(b.ts) = m.mo""",
    "obs_clean": """SELECT ts, event_id, user_id, coalesce(category, 'Unknown') AS category,
        coalesce(value, (SELECT median(value) FROM obs_fixed)) AS value,
        coalesce(CAST(k AS DOUBLE), (SELECT median(k) FROM obs_fixed)) AS k, tag, is_tag
        FROM obs_fixed""",
    "hourly": f"""SELECT hour_ts, event_id, category, value, k, CAST(sev AS INTEGER) AS sev
        FROM (SELECT *, row_number() OVER (PARTITION BY hour_ts ORDER BY sev DESC, event_id) AS rn
              FROM (SELECT *, {_SEV} AS sev FROM obs) a) b WHERE rn = 1""",
    "gappy": """SELECT * FROM hourly WHERE NOT (day(hour_ts) = 11
        OR (hour(hour_ts) = 3 AND day(hour_ts) IN (5, 17)))""",
    "daily": """SELECT o_orderkey, o_orderdate AS ts, o_totalprice AS volume,
        o_orderpriority AS category, o_custkey FROM orders""",
    "daily_tagged": """SELECT d.*, m.tag FROM daily d LEFT JOIN (
            SELECT CAST(ts AS DATE) AS day_, min(o_orderkey) AS k_,
                   CASE WHEN month(ts) = 1 THEN 'new_year' ELSE 'labor' END AS tag
            FROM daily WHERE (month(ts) = 1 AND day(ts) = 1) OR (month(ts) = 9 AND day(ts) = 4)
            GROUP BY 1, 3) m ON CAST(d.ts AS DATE) = m.day_ AND d.o_orderkey = m.k_""",
    "finput": """SELECT event_id, ts, hour_ts, category, value AS measure, k,
        CAST(k + 243.15 AS DOUBLE) AS temp,
        CASE WHEN category = 'purchase' THEN value / 10 ELSE 0.0 END AS rain_1h,
        CASE WHEN category = 'error' AND k < 30 THEN value / 10 ELSE 0.0 END AS snow_1h,
        CAST(k AS DOUBLE) AS clouds_all,
        CAST(CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS INTEGER) AS is_holiday
        FROM obs""",
    "fstat": """SELECT avg(temp) AS t_m, stddev_pop(temp) AS t_s, min(temp) AS t_lo,
        max(temp) AS t_hi, avg(clouds_all) AS c_m, stddev_pop(clouds_all) AS c_s,
        min(clouds_all) AS c_lo, max(clouds_all) AS c_hi, quantile_cont(measure, 0.25) AS q1,
        quantile_cont(measure, 0.5) AS q2, quantile_cont(measure, 0.75) AS q3 FROM finput""",
    "fcount": "SELECT category, count(*) AS n_cat FROM finput GROUP BY 1",
    "ftime": """SELECT f.*, CAST(hour(ts) AS INTEGER) AS hour,
        CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
        CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
        sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
        sin(2 * pi() * (isodow(ts) - 1) / 7) AS dow_sin,
        cos(2 * pi() * (isodow(ts) - 1) / 7) AS dow_cos FROM finput f""",
    "fgroup": """SELECT t.*, CASE WHEN n_cat < 1985 THEN 'Other' ELSE t.category END
        AS category_grouped FROM ftime t JOIN fcount USING (category)""",
    "feat": """SELECT g.*, """ + ", ".join(
        f"CAST(category_grouped = '{v}' AS INTEGER) AS \"cat_{v}\""
        for v in ("click", "error", "purchase", "signup", "view", "Other")) + """,
        CAST(category IN ('error', 'purchase') AS INTEGER) AS is_precipitation,
        CAST(category IN ('view') AS INTEGER) AS is_low_visibility,
        CAST(rain_1h > 0 AS INTEGER) AS has_rain, CAST(snow_1h > 0 AS INTEGER) AS has_snow,
        temp - 273.15 AS temp_celsius, (temp - t_m) / t_s AS temp_z,
        (temp - t_lo) / (t_hi - t_lo) AS temp_minmax, (clouds_all - c_m) / c_s AS clouds_all_z,
        (clouds_all - c_lo) / (c_hi - c_lo) AS clouds_all_minmax,
        CASE WHEN measure <= q1 THEN 'Low' WHEN measure <= q2 THEN 'Moderate'
             WHEN measure <= q3 THEN 'High' ELSE 'Severe' END AS congestion_level,
        CASE WHEN measure <= q1 THEN 0 WHEN measure <= q2 THEN 1 WHEN measure <= q3 THEN 2
             ELSE 3 END AS congestion_code,
        CAST(measure > 60 AS INTEGER) AS is_congested,
        CAST(measure > q2 AND category IN ('error', 'purchase', 'view') AS INTEGER) AS high_risk
        FROM fgroup g, fstat""",
    # predictions that both engines derive the same way from the observations
    "preds": """SELECT event_id, hour_ts, ts, category, value AS y,
        CAST(round(49.0 + (k - 50) / 5.0 + isodow(ts), 3) AS DOUBLE) AS prediction FROM obs""",
    "scores": """SELECT event_id, category, CAST(value > 60 AS INTEGER) AS y,
        (k + 5 * CAST(category IN ('signup', 'click') AS INTEGER)) / 110.0 AS score,
        CAST(k + 5 * CAST(category IN ('signup', 'click') AS INTEGER) >= 52 AS INTEGER)
            AS prediction FROM obs""",
}

_WORD = re.compile(r"[a-z_][a-z_0-9]*", re.IGNORECASE)


def _needed(text: str, seen: set[str]) -> None:
    for word in set(_WORD.findall(text)):
        if word in VIEWS and word not in seen:
            seen.add(word)
            _needed(VIEWS[word], seen)


def with_views(body: str) -> str:
    """Prefix a check with the shared views it mentions, directly or not."""
    seen: set[str] = set()
    _needed(body, seen)
    heads = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in seen]
    text = body.strip()
    if not heads:
        return text
    if text.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + text[5:]
    return "WITH " + ",\n".join(heads) + "\n" + text


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its check."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = with_views(check)
        return fn
    return add
