"""Scalar building blocks.  Each takes and returns a Column."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- calendar ---------------------------------------------------------------
def floor_hour(ts: Column | str) -> Column:
    """Whole hour of a zone-less timestamp (stays TIMESTAMP_NTZ)."""
    return F.date_trunc("hour", col(ts)).cast("timestamp_ntz")


def floor_month(ts: Column | str) -> Column:
    return F.date_trunc("month", col(ts)).cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp (session zone is UTC)."""
    return F.unix_seconds(col(ts).cast("timestamp"))


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def epoch_hours(ts: Column | str) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(3600)).cast("bigint")


def day_of_week(ts: Column | str) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(col(ts)).cast("int")


def weekend_flag(ts: Column | str) -> Column:
    return (day_of_week(ts) >= 5).cast("int")


def cyclic(c: Column | str, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a periodic integer."""
    angle = col(c) * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


# --- text -------------------------------------------------------------------
def strip_text(c: Column | str) -> Column:
    """Trim every kind of blank on both ends, not only spaces."""
    return F.btrim(col(c), F.lit(BLANKS))


def sentinel_to_null(c: Column | str, sentinel: str = "None") -> Column:
    return F.nullif(col(c), F.lit(sentinel))


# --- recoding ---------------------------------------------------------------
def ordinal(c: Column | str, ranks: Mapping[str, int], default: int) -> Column:
    """Category to integer rank; unknown and null categories get ``default``."""
    c = col(c)
    chain = reduce(lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])), ranks.items(), F)
    return chain.otherwise(F.lit(default))


def member_flag(c: Column | str, members: Sequence[str]) -> Column:
    """1 when the value is in the list, 0 otherwise (null counts as 0)."""
    return F.coalesce(col(c).isin(list(members)), F.lit(False)).cast("int")


def positive_flag(c: Column | str) -> Column:
    return F.coalesce(col(c) > 0, F.lit(False)).cast("int")


def cut_labels(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(e0, e1], (e1, e2], ...``; outside is null."""
    c = col(c)
    chain = F
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        chain = chain.when((c > low) & (c <= high), F.lit(label))
    return chain


def band(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Three open-ended bands: below the first cut, up to the second, above."""
    c = col(c)
    return (F.when(c < cuts[0], labels[0])
             .when(c <= cuts[1], labels[1])
             .when(c > cuts[1], labels[2]))


def right_closed_bin(c: Column | str, start: float, step: float, n: int) -> Column:
    """Index 0..n-1 of a right-closed equal-step bin, null outside."""
    c = col(c)
    inside = (c > start) & (c <= start + step * n)
    return F.when(inside, (F.ceil((c - start) / step) - 1).cast("int"))


# --- arithmetic -------------------------------------------------------------
def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that gives null, not an error, on a zero denominator."""
    return F.try_divide(col(num), col(den))


def pct_change(new: Column | str, old: Column | str) -> Column:
    return F.try_divide(F.lit(100.0) * (col(new) - col(old)), col(old))


def mean_flag(cond: Column) -> Column:
    """Share of rows where the condition holds (null counts as false)."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("int"))


def count_rows(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def status_band(value: Column | str, warn: float | None, alert: float) -> Column:
    value = col(value)
    chain = F.when(value >= alert, "ALERT")
    if warn is not None:
        chain = chain.when(value >= warn, "WARN")
    return chain.otherwise("PASS")


def status_rank(status: Column | str) -> Column:
    return F.when(col(status) == "ALERT", 2).when(col(status) == "WARN", 1).otherwise(0)


def status_name(rank: Column | str) -> Column:
    return F.when(col(rank) == 2, "ALERT").when(col(rank) == 1, "WARN").otherwise("PASS")


def thousands(c: Column | str, digits: int = 0) -> Column:
    return F.format_number(col(c), digits)


def hour_label(h: Column | str) -> Column:
    return F.format_string("%02d:00", col(h).cast("int"))


# --- one-row tables ---------------------------------------------------------
def scalar(one_row: DataFrame) -> Column:
    """A one-row table as a struct-valued scalar subquery.

    For reports that use a statistic once or twice: no join, and nothing but
    the one aggregated row travels.
    """
    return one_row.select(F.struct(*one_row.columns)).scalar()


def fitted(one_row: DataFrame) -> dict[str, Column]:
    """Run a one-row aggregate now and return its fields as literals.

    This is the estimator step: statistics that later rows are measured
    against are computed once, not again in every job that uses the rows.
    The driver receives one row of fixed width.
    """
    row = one_row.first()
    kinds = {f.name: f.dataType for f in one_row.schema.fields}
    return {name: F.lit(row[name] if row is not None else None).cast(kind)
            for name, kind in kinds.items()}
