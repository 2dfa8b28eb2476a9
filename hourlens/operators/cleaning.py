"""Cleaning steps with an audit of what each one changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions.quantiles import median
from hourlens.operators.relational import propagate_tag
from hourlens.operators.windows import keep_best
from hourlens.session import work_dir
from hourlens.sources.sinks import write_stage


def parse_timestamp(text: Column | str) -> Column:
    """Lenient text to TIMESTAMP_NTZ; unreadable text becomes null."""
    return fc.strip_text(text).try_cast("timestamp_ntz")


def parse_drop(df: DataFrame, text: str, ts: str = "ts") -> DataFrame:
    """Parse the timestamp text and drop rows that cannot be read."""
    return (df.withColumn(ts, parse_timestamp(text))
            .dropna(subset=[ts]).drop(*([text] if text != ts else [])))


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fc.strip_text(c) for c in columns})


def standardise(df: DataFrame, text: Sequence[str], tag: str, ts: str = "ts") -> DataFrame:
    """Trim text columns, then spread the sparse tag over its dates.

    Must run before de-duplication: the tagged row may be the one dropped.
    """
    return propagate_tag(trim_columns(df, text), tag, ts)


def range_check(bounds: Mapping[str, tuple[float | None, float | None]]) -> dict[str, Column]:
    """Per column, a predicate that is true only for an out-of-range value."""
    checks = {}
    for name, (low, high) in bounds.items():
        parts = []
        if low is not None:
            parts.append(F.col(name) < low)
        if high is not None:
            parts.append(F.col(name) > high)
        checks[name] = F.coalesce(reduce(lambda a, b: a | b, parts), F.lit(False))
    return checks


def valid_medians(df: DataFrame, checks: Mapping[str, Column], ts: str = "ts") -> DataFrame:
    """``month, column, median`` over in-range values, all columns in one job."""
    wide = df.select(F.month(ts).alias("month"), *[
        F.when(~bad, F.col(name).cast("double")).alias(name) for name, bad in checks.items()])
    return median(wide.unpivot(["month"], list(checks), "column", "value"),
                  "value", ["month", "column"], few_groups=True).select("month", "column", "median")


def impute_range(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]],
                 ts: str = "ts") -> DataFrame:
    """Replace out-of-range values by the median of the valid rows of the month.

    Null is not out of range.  A month without any valid row yields null, left
    for ``fill_missing``.  The medians, at most twelve per column, are computed
    once and become literals: the rows themselves are neither joined nor moved.
    """
    checks = range_check(bounds)
    found = {(r["month"], r["column"]): r["median"] for r in valid_medians(df, checks, ts).collect()}

    def lookup(name: str) -> Column:
        by_month = [F.lit(found.get((m, name))).cast("double") for m in range(1, 13)]
        return F.element_at(F.array(*by_month), F.month(ts))

    return df.withColumns({
        name: F.when(bad, lookup(name)).otherwise(F.col(name).cast("double"))
        for name, bad in checks.items()})


def column_medians(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """One row with the exact median of every column (null if all null)."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    long = wide.unpivot([], list(numeric), "column", "value")
    return median(long, "value", ["column"], few_groups=True).agg(*[
        F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in numeric])


def fill_missing(df: DataFrame, numeric: Sequence[str], text: Sequence[str],
                 label: str = "Unknown") -> DataFrame:
    """Numeric nulls get the column median, text nulls a label."""
    mids = fc.fitted(column_medians(df, numeric))
    return df.withColumns({
        **{c: F.coalesce(F.col(c).cast("double"), mids[c]) for c in numeric},
        **{c: F.coalesce(F.col(c), F.lit(label)) for c in text}})


@dataclass
class CleanConfig:
    """What to clean.  The defaults are the domain's own columns and limits."""

    timestamp_text: str | None = "date_time"
    ts: str = "ts"
    category: str = "weather_main"
    text: Sequence[str] = ("weather_main", "weather_description", "holiday")
    fill_text: Sequence[str] = ("weather_main", "weather_description")
    numeric: Sequence[str] = ("temp", "rain_1h", "snow_1h", "clouds_all", "traffic_volume")
    tag: str = "holiday"
    tag_sentinel: str | None = "None"
    bounds: Mapping[str, tuple[float | None, float | None]] = field(default_factory=lambda: {
        "temp": config.TEMP_BOUNDS_K, "rain_1h": (None, config.RAIN_MAX_MM)})
    # a zero here is implausible but kept, as the true value is unknown; the audit counts it
    zero_kept: Sequence[str] = ("traffic_volume",)
    severity: Mapping[str, int] = field(default_factory=lambda: dict(config.DEDUP_SEVERITY))
    # ties on severity: the engine has no row order, so a full tie-break is named
    tiebreak: Sequence[str] = ("weather_main", "weather_description", "traffic_volume", "temp",
                               "rain_1h", "snow_1h", "clouds_all")


def clean(df: DataFrame, cfg: CleanConfig | None = None, stage: str | None = None) -> DataFrame:
    """Parse, standardise, de-duplicate, impute, fill: in that order.

    The de-duplicated rows are written to a stage table (by default in the
    shared working folder), because the medians read them four more times and
    the shuffle behind them should run once.
    """
    cfg = cfg or CleanConfig()
    spark = df.sparkSession
    if cfg.tag_sentinel is not None:
        df = df.withColumn(cfg.tag, fc.sentinel_to_null(cfg.tag, cfg.tag_sentinel))
    if cfg.timestamp_text:
        df = parse_drop(df, cfg.timestamp_text, cfg.ts)
    df = standardise(df, cfg.text, cfg.tag, cfg.ts)
    # keep_best subsumes the exact-duplicate pass: identical rows tie and one stays
    df = keep_best(df, cfg.ts, fc.ordinal(cfg.category, cfg.severity, -1), cfg.tiebreak)
    df = spark.read.parquet(write_stage(df, stage or work_dir(spark, "deduplicated")))
    df = impute_range(df, cfg.bounds, cfg.ts)
    return fill_missing(df, cfg.numeric, cfg.fill_text)


def clean_audited(raw: DataFrame, cfg: CleanConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """The cleaned rows and the audit, ``step, reason, rows_affected``, of the same run.

    The raw input is read once (and its tagged dates for the tag dimension).  What parsing, trimming and tagging
    change is noted row by row in flags of the standardised stage, so the counts read a few narrow columns of the two
    tables that the run writes anyway.
    """
    cfg = cfg or CleanConfig()
    spark = raw.sparkSession
    text = cfg.timestamp_text or cfg.ts
    if cfg.tag_sentinel is not None:
        raw = raw.withColumn(cfg.tag, fc.sentinel_to_null(cfg.tag, cfg.tag_sentinel))
    parsed = raw.withColumn("_ts", parse_timestamp(F.col(text).cast("string")))
    parsed = parsed.withColumns({"_ok": F.col("_ts").isNotNull(), "_tagged": F.col(cfg.tag).isNotNull(), **{
        f"_trim_{c}": F.coalesce(F.col(c) != fc.strip_text(c), F.lit(False)) for c in cfg.text}})
    gone = {text, "_ts"} - {cfg.ts}
    rows = trim_columns(parsed.withColumn(cfg.ts, F.col("_ts")).drop(*gone), cfg.text)
    tags = rows.where(F.col("_ok") & F.col(cfg.tag).isNotNull()).select(
        F.to_date(cfg.ts).alias("tag_date"), cfg.tag)
    noted = spark.read.parquet(write_stage(
        propagate_tag(rows, cfg.tag, cfg.ts, tags), work_dir(spark, "standardised")))
    good = F.col("_ok")
    b = fc.fitted(noted.agg(
        F.count_if(~good).alias("parse"), *[F.count_if(good & F.col(f"_trim_{c}")).alias(f"trim_{c}") for c in cfg.text],
        F.count_if(good & F.col("_tagged")).alias("tagged"),
        F.count_if(good & F.col(cfg.tag).isNotNull()).alias("spread")))
    std = noted.where("_ok").drop("_ok", "_tagged", *[f"_trim_{c}" for c in cfg.text])

    distinct = std.groupBy(*std.columns).agg(F.count("*").alias("_c"))
    per_ts = distinct.groupBy(cfg.ts).agg(F.sum("_c").alias("_rows"), F.count("*").alias("_kinds"))
    dups = fc.fitted(per_ts.agg(F.coalesce(F.sum("_rows") - F.sum("_kinds"), F.lit(0)).alias("exact"),
                                F.coalesce(F.sum("_kinds") - F.count("*"), F.lit(0)).alias("repeated")))

    checks = range_check(cfg.bounds)
    best = keep_best(std, cfg.ts, fc.ordinal(cfg.category, cfg.severity, -1), cfg.tiebreak)
    best = spark.read.parquet(write_stage(best, work_dir(spark, "deduplicated")))
    a = fc.fitted(best.agg(
        F.count("*").alias("rows_out"),
        *[fc.count_rows(bad).alias(f"range_{c}") for c, bad in checks.items()],
        *[fc.count_rows(F.col(c) == 0).alias(f"zero_{c}") for c in cfg.zero_kept],
        *[fc.count_rows(F.col(c).isNull()).alias(f"null_{c}") for c in [*cfg.numeric, *cfg.fill_text]]))

    lines = [("parse", "timestamp could not be parsed", b["parse"])]
    lines += [("standardise", f"blanks around {c}", b[f"trim_{c}"]) for c in cfg.text]
    lines += [("standardise", f"{cfg.tag} spread over tagged dates", b["spread"] - b["tagged"]),
              ("dedup", "identical rows", dups["exact"]),
              ("dedup", "repeated timestamps", dups["repeated"])]
    lines += [("impute", f"{c} out of range", a[f"range_{c}"]) for c in checks]
    lines += [("impute", f"{c} of zero retained", a[f"zero_{c}"]) for c in cfg.zero_kept]
    lines += [("fill", f"{c} missing", a[f"null_{c}"]) for c in [*cfg.numeric, *cfg.fill_text]]
    lines += [("output", "rows kept", a["rows_out"])]
    report = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("step"), F.lit(r).alias("reason"),
                 n.cast("bigint").alias("rows_affected")) for s, r, n in lines])))
    return fill_missing(impute_range(best, cfg.bounds, cfg.ts), cfg.numeric, cfg.fill_text), report


def audit(raw: DataFrame, cfg: CleanConfig | None = None) -> DataFrame:
    """The audit of a cleaning run."""
    return clean_audited(raw, cfg)[1]
