"""Exact order statistics that stay distributed.

``percentile`` keeps every distinct value of a group in one task, which is fine
for bounded domains (hours, percents) and fatal for continuous measures.  Here
an approximate sketch first brackets every wanted rank, then one more scan
counts, by distinct value, only what lies inside the brackets.  Everything
outside collapses into one counted row per gap, so the second pass shuffles a
sliver of the data and the ranks are still exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens.functions.columns import col, scalar

ACCURACY = 100_000
SLACKS = (1.0, 0.05, 5e-3, 5e-4)    # half widths of a bracket, besides 5 / accuracy


def _count_edges(edges: Column, m: int, test: Callable[[Column], Column]) -> Column:
    """How many of ``m`` edges pass: unrolled when few, a lambda when many.

    Unrolling many comparisons makes a method the JIT refuses to compile.
    """
    if m <= 3:
        return reduce(lambda a, b: a + b, [test(edges[i]).cast("int") for i in range(m)])
    return F.size(F.filter(edges, test))


def _order_values(df: DataFrame, value: Column | str, by: Sequence[str], marks: Sequence[float],
                  ranks: dict[str, str], accuracy: int, few_groups: bool = False) -> DataFrame:
    """One row per group: ``n`` and, per named rank, the value at that 0-based rank.

    ``ranks`` are SQL expressions over the group size ``_n``; ``marks`` are the
    fractions around which they lie.
    """
    x = col(value).cast("double")
    src = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("_x"))
    # The sketch is off by at most n / accuracy ranks, a fifth of the narrowest slack.  A bracket
    # also has to hold the two ranks around its mark, so a group takes the narrowest slack
    # that is worth three of its ranks or more; the widest reaches from its least to its greatest value.
    slacks = [*(s for s in SLACKS if s > 5.0 / accuracy), 5.0 / accuracy]
    m = len(marks)
    fractions = [min(1.0, max(0.0, x)) for s in slacks
                 for x in [k - s for k in marks] + [k + s for k in marks]]
    level = reduce(lambda a, b: a + b, [(F.col("_n") * s >= 3).cast("int") for s in slacks[1:]])
    brackets = src.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_x", fractions, accuracy).alias("_b")).withColumn(
        "_at", level * (2 * m) + 1).select(
        *by, "_n", F.slice("_b", F.col("_at"), m).alias("_low"),
        F.slice("_b", F.col("_at") + m, m).alias("_high"))

    if by:
        side = brackets.select(*[F.col(c).alias(f"_g_{c}") for c in by], "_n", "_low", "_high")
        match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by])
        joined = src.join(F.broadcast(side) if few_groups else side, match)
        n, lows, highs = F.col("_n"), F.col("_low"), F.col("_high")
    else:
        # bound to a column once, so the subquery appears once in the plan
        joined = src.withColumn("_one", scalar(brackets))
        n, lows, highs = F.col("_one._n"), F.col("_one._low"), F.col("_one._high")

    begun = _count_edges(lows, m, lambda e: e <= F.col("_x"))
    ended = _count_edges(highs, m, lambda e: e < F.col("_x"))
    staged = joined.select(*by, n.alias("_n"), "_x", begun.alias("_a"), ended.alias("_e"))
    # a bracket is open when more brackets have begun than ended; begun + ended
    # steps up at every edge, so it orders gaps and brackets like x does
    inside, region = F.col("_a") > F.col("_e"), F.col("_a") + F.col("_e")
    # The group size is the same for every row of a group; it rides along.
    kept = staged.select(*by, "_n", region.alias("_r"),
                         F.when(inside, F.col("_x")).alias("_v"))
    counted = kept.groupBy(*by, "_r", "_v").agg(F.count("*").alias("_c"),
                                                F.max("_n").alias("_n"))
    # each bracket is ranked in its own task; only bracket totals (a fixed few
    # per group) are added up across brackets
    inner = Window.partitionBy(*by, "_r").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    # both readers of the counts use all of their columns, so one exchange serves both
    totals = counted.groupBy(*by, "_r").agg(F.sum("_c").alias("_t"), F.max("_n").alias("_tn"))
    offsets = totals.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("_r").alias("_g_r"),
                            "_tn", F.coalesce(F.sum("_t").over(across), F.lit(0)).alias("_off"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by],
                  F.col("_r") == F.col("_g_r"))
    cum = (counted.withColumn("_in", F.sum("_c").over(inner))
           .join(F.broadcast(offsets) if few_groups else offsets, same)
           .withColumn("_hi", F.col("_off") + F.col("_in"))
           .withColumn("_lo", F.col("_hi") - F.col("_c")))

    def at(k: str) -> str:
        return (f"coalesce(max(CASE WHEN _lo <= {k} AND {k} < _hi THEN _v END), "
                "CAST(raise_error('order statistic outside its bracket') AS DOUBLE))")

    return cum.groupBy(*by).agg(F.max("_tn").alias("n"),
                                *[F.expr(at(k)).alias(name) for name, k in ranks.items()])


def quantiles(df: DataFrame, value: Column | str, probs: Sequence[float], by: Sequence[str] = (),
              *, bounded: bool = False, few_groups: bool = False,
              accuracy: int = ACCURACY) -> DataFrame:
    """Linear-interpolation quantiles: ``by..., n, q`` with ``q`` an array.

    bounded       the value comes from a fixed small domain, use ``percentile``
    few_groups    the groups are fixed by the caller (months, named columns), not by the
                  data: their bracket table may then be broadcast
    """
    by = list(by)
    if bounded:
        x = col(value).cast("double")
        return df.where(x.isNotNull()).groupBy(*by).agg(
            F.count("*").alias("n"),
            F.percentile(x, F.array(*[F.lit(float(p)) for p in probs])).alias("q"))

    ranks, cells = {}, []
    for i, p in enumerate(probs):
        pos = f"({float(p)!r}D * (_n - 1))"
        ranks[f"_f{i}"], ranks[f"_t{i}"] = f"floor({pos})", f"ceil({pos})"
        pos = pos.replace("_n", "n")
        cells.append(f"_f{i} + (_t{i} - _f{i}) * ({pos} - floor({pos}))")
    found = _order_values(df, value, by, probs, ranks, accuracy, few_groups)
    return found.select(*by, "n", F.expr(f"array({', '.join(cells)})").alias("q"))


def median(df: DataFrame, value: Column | str, by: Sequence[str] = (), **kw) -> DataFrame:
    """``by..., n, median``."""
    out = quantiles(df, value, [0.5], by, **kw)
    return out.select(*by, "n", F.col("q")[0].alias("median"))


def value_at_fraction(df: DataFrame, value: Column | str, fraction: float,
                      accuracy: int = ACCURACY) -> DataFrame:
    """One row ``n, value``: the value at 0-based rank ``floor(fraction * n)``."""
    found = _order_values(df, value, [], [fraction],
                          {"_k": f"least(floor({float(fraction)!r}D * _n), _n - 1)"},
                          accuracy)
    return found.select("n", F.col("_k").alias("value"))
