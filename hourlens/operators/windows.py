"""Change, de-duplication, history and run operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens import config
from hourlens.functions import columns as fc
from hourlens.functions.quantiles import value_at_fraction


def lag_change(df: DataFrame, order: str, measures: Sequence[str],
               partition: Sequence[str] = (), pct: bool = True) -> DataFrame:
    """Change (and % change) against the previous row.

    Meant for tables that are already aggregated to one row per period, which
    is why a window without a partition is safe here.
    """
    w = Window.partitionBy(*partition).orderBy(order)
    extra = {}
    for m in measures:
        prev = F.lag(m).over(w)
        extra[f"{m}_change"] = F.col(m) - prev
        if pct:
            extra[f"{m}_pct_change"] = fc.pct_change(m, prev)
    return df.withColumns(extra)


def keep_best(df: DataFrame, ts: str, severity: Column, tiebreak: Sequence[str]) -> DataFrame:
    """One row per timestamp: highest severity, then the smallest tie-break.

    The winner of a timestamp is found by a hash aggregate over one fixed-width number, severity
    first, tie-break second, so rows are reduced before the shuffle without being sorted; an hour
    holding a third of the rows costs one number per task.  The winners' rows are then fetched
    by (timestamp, key).  Other tie-breaks than one whole-number column need a sort aggregate.
    """
    kind = dict(df.dtypes).get(tiebreak[0]) if len(tiebreak) == 1 else None
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        return _keep_best_by_rank(df, ts, severity, tiebreak)
    key = F.coalesce(F.col(tiebreak[0]).cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    unit = F.lit("1" + "0" * 20).cast("decimal(21,0)")
    level = F.coalesce(severity, F.lit(-2**31)).cast("decimal(12,0)")
    packed = (level * unit - key).cast("decimal(38,0)")
    ranked = df.withColumn("_rank", packed)
    top = ranked.groupBy(F.col(ts).alias("_ts")).agg(F.max("_rank").alias("_top"))
    won = ranked.join(top, ranked[ts].eqNullSafe(top["_ts"]) & (F.col("_rank") == F.col("_top")))
    # equal keys in one timestamp: one of the rows, which windows over winners only decide
    rest = [c for c in df.columns if c != ts]
    first = F.row_number().over(Window.partitionBy(ts).orderBy(*rest)) == 1
    return won.withColumn("_one", first).where("_one").select(*df.columns)


def _keep_best_by_rank(df: DataFrame, ts: str, severity: Column,
                       tiebreak: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c != ts]
    best = F.min_by(F.struct(*rest), F.struct((-severity).alias("_s"), *tiebreak))
    return (df.groupBy(ts).agg(best.alias("_row"))
            .select(*[F.col(ts) if c == ts else F.col(f"_row.{c}").alias(c)
                      for c in df.columns]))


def dedup(df: DataFrame, ts: str, category: str, tiebreak: Sequence[str],
          severity: Mapping[str, int] = config.DEDUP_SEVERITY) -> DataFrame:
    """Drop identical rows, then keep the most severe row of each timestamp."""
    return keep_best(df.dropDuplicates(), ts, fc.ordinal(category, severity, -1), tiebreak)


def _with_halo(df: DataFrame, ts: str, steps: int, key: Sequence[str],
               block_hours: int) -> DataFrame:
    """Cut the time axis into blocks and lend each block the hours before it.

    Windows can then be partitioned by block: no task sees more than
    ``block_hours + steps`` hours of a series.
    """
    if steps > block_hours:
        raise ValueError(f"a history of {steps} hours does not fit blocks of {block_hours}")
    h = fc.epoch_hours(ts)
    home = F.floor(F.col("_h") / block_hours)
    lend = (F.col("_h") % block_hours) >= block_hours - steps
    return (df.withColumn("_h", h).withColumn("_home", home)
            .withColumn("_blk", F.explode(F.when(lend, F.array("_home", F.col("_home") + 1))
                                           .otherwise(F.array("_home")))))


def history(df: DataFrame, ts: str, columns: Sequence[str], target: str,
            steps: int = config.HISTORY_STEPS, key: Sequence[str] = (),
            block_hours: int = 24 * 28) -> DataFrame:
    """Rows whose ``steps`` previous hours all exist, with those hours as an array.

    ``df`` has one row per hour (and series key).  With unique hours, a full
    frame of ``steps`` hours is the same as the row ``steps`` places back lying
    exactly ``steps`` hours earlier.
    """
    halo = _with_halo(df, ts, steps, key, block_hours)
    w = (Window.partitionBy(*key, "_blk").orderBy("_h").rangeBetween(-steps, -1))
    seq = F.collect_list(F.struct(F.col("_h").alias("_t"), *columns)).over(w)
    return (halo.withColumn("_seq", seq)
            .where((F.col("_blk") == F.col("_home")) & (F.size("_seq") == steps))
            .select(*key, ts, F.col(target).alias("target"), F.array_sort("_seq").alias("history")))


def contiguity(df: DataFrame, ts: str, steps: int = config.HISTORY_STEPS,
               key: Sequence[str] = (), block_hours: int = 24 * 28) -> DataFrame:
    """One row: hours, candidate windows, kept and dropped ones."""
    halo = _with_halo(df.select(*key, ts), ts, steps, key, block_hours)
    w = Window.partitionBy(*key, "_blk").orderBy("_h").rangeBetween(-steps, -1)
    full = (halo.withColumn("_n", F.count("*").over(w)).where("_blk = _home"))
    return full.groupBy(*key).agg(
        F.count("*").alias("n_hours"),
        F.greatest(F.count("*") - steps, F.lit(0)).alias("n_candidates"),
        F.count_if(F.col("_n") == steps).alias("n_kept")).withColumn(
        "n_dropped", F.col("n_candidates") - F.col("n_kept"))


def consecutive_runs(df: DataFrame, column: str, key: Sequence[str] = ()) -> DataFrame:
    """Islands of +1 steps among distinct integers: start, end, length.

    Input is a handful of hours per key (at most 24).
    """
    w = Window.partitionBy(*key).orderBy(column)
    return (df.select(*key, column).distinct()
            .withColumn("_island", F.col(column) - F.row_number().over(w))
            .groupBy(*key, "_island")
            .agg(F.min(column).alias("run_start"), F.max(column).alias("run_end"),
                 F.count("*").alias("run_length"))
            .drop("_island"))


def longest_run(runs: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Longest run per key, the first one on a tie."""
    best = F.min_by(F.struct("run_start", "run_end", "run_length"),
                    F.struct((-F.col("run_length")).alias("n"), "run_start"))
    return runs.groupBy(*key).agg(best.alias("_r")).select(*key, "_r.*")


def chrono_split(df: DataFrame, ts: str, fraction: float = 0.8, key: str | None = None) -> DataFrame:
    """Add ``is_train``: the first ``floor(fraction * n)`` rows in time order.

    Rows of one timestamp are told apart by ``key``, a unique whole number; without it they all go
    to the test side where the cut falls among them.  The cut is an exact order statistic, so no task
    has to number the whole table.
    """
    at = fc.epoch_micros(ts).cast("double")
    cut = fc.fitted(value_at_fraction(df.select(at.alias("_e")), "_e", fraction))
    if key is None:
        return df.withColumn("is_train", at < cut["value"])
    edge = df.select(at.alias("_e"), F.col(key).cast("double").alias("_k"))
    sizes = edge.agg(F.count_if(F.col("_e") < cut["value"]).alias("before"),
                     F.count_if(F.col("_e") == cut["value"]).alias("ties"), F.count("_e").alias("n")).first()
    wanted = math.floor(fraction * sizes["n"]) - sizes["before"]        # of the rows at the cut
    if wanted <= 0:
        return df.withColumn("is_train", at < cut["value"])
    if wanted >= sizes["ties"]:
        return df.withColumn("is_train", at <= cut["value"])
    last = fc.fitted(value_at_fraction(edge.where(F.col("_e") == cut["value"]), "_k", (wanted + 0.5) / sizes["ties"]))
    return df.withColumn("is_train", (at < cut["value"]) | (
        (at == cut["value"]) & (F.col(key).cast("double") < last["value"])))


def enumerate_ranked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rank 1..k over a short, already limited table."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
