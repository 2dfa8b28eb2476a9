"""Mixing sources to target weights: systematic sampling along prefix sums.

Inside a source every document has the same expected number of copies (target / source size), so
the prefix sum before a document is that rate times the document's place.  Places follow (size, id):
neighbours on the number line have like sizes, which keeps the words taken near the target.  One
random offset per source is added, and a document is emitted once for each integer the sum crosses.
Places come from key ranges (a count per block and source, a row number inside), so a source with
a third of all rows is spread over as many tasks as it needs.

Defined results: a null or empty text has size 0; null is a source of its own, the last; sources of size
0 have target 0 and nothing is taken; repeated rows are documents of their own; an empty table gives
an empty result; the offset depends on seed and source alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourlens.llm.common import Stages, block_offsets, range_blocks

WORD = r"[^\x20\x09-\x0D]++"
BIG = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: tuple[int, int] = (3, 2),
                   most: int = 2) -> DataFrame:
    """Target size per source: ``share`` (a fraction) of all sizes, dealt by weight, at most
    ``most`` times a source's size, what is above dealt again.

    ``sizes`` has one row per source, so its windows see sources, never documents.  Sources
    that reach their limit are those with the smallest size per weight; after sorting by it, source i is full
    if its limit is no more than its part of what the fuller ones before it leave.
    """
    up, down = share
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights)) + 1)
    rated = sizes.withColumn("w", weight.cast("long"))
    thin = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = thin.rowsBetween(Window.unboundedPreceding, -1), thin.rowsBetween(
        0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    laid = (rated.withColumn("total", F.sum("source_size").over(everything).cast(BIG))
            .withColumn("used", (F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
                        .cast(BIG))
            .withColumn("left_w", F.sum("w").over(rest).cast(BIG)))
    fits = (F.col("source_size").cast(BIG) * (most * down) * F.col("left_w")
            <= (F.col("total") * up - F.col("used") * down) * F.col("w"))
    full = laid.withColumn("full", F.min(fits.cast("int")).over(
        thin.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))).over(everything),
                       F.lit(0)) * most
    dealt = (F.col("w").cast(BIG) * (F.col("total") * up - spent.cast(BIG) * down)).cast("double")
    return full.select("source", "source_size", F.when(
        F.col("full"), (F.col("source_size") * most).cast("double")).otherwise(
        dealt / (open_w * down).cast("double")).alias("target"))


def offset(source: Column, seed: str) -> Column:
    """One number in [0, 1) per source."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draw(docs: DataFrame, keep: list[str], weights=(3, 1, 2), share=(3, 2), most: int = 2,
         seed: str = "mix") -> DataFrame:
    """``keep`` columns of ``docs`` (with ``doc_id``, ``source``, ``size``) plus source_size,
    target and copies, the number of times a document goes into the mix."""
    stages = Stages(docs.sparkSession, "mix")
    counted = stages.write(docs)            # the ranges sample their input: count words once
    blocks = range_blocks(stages, counted, "source", "size", "doc_id")
    stages.drop(counted)
    sizes = blocks.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "_s")
    starts = block_offsets(blocks, F.lit(1), ["source"]).select(
        F.col("source").alias("_t"), F.col("block").alias("_b"), "before")
    inside = Window.partitionBy("block", "source").orderBy("size", "doc_id")
    placed = blocks.withColumn("_row", F.row_number().over(inside) - 1)
    full = (placed.join(starts, F.col("source").eqNullSafe(F.col("_t"))
                        & (F.col("block") == F.col("_b")))
            .join(targets, F.col("source").eqNullSafe(F.col("_s"))))
    rate = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    place, shift = F.col("before") + F.col("_row"), offset(F.col("source"), seed)
    copies = F.floor(rate * (place + 1) + shift) - F.floor(rate * place + shift)
    return full.select(*keep, "source_size", "target", copies.alias("copies"))


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (words, repeats counted)."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return draw(sized, ["doc_id", "size"], seed=seed).withColumn(
        "taken", F.col("copies") * F.col("size"))
