"""Line de-duplication over the whole corpus, keeping each line's first occurrence.

Every line becomes (128-bit hash, document, position); the text stays behind.  The rows are cut
into ranges of (hash, document, position), so a line that a third of all documents hold fills several
ranges, and streamed in that order: the first row of a hash names the document that keeps the
line.  Only a hash at the edge of a range can go on in the next one; those few are looked up
by themselves.  The result per document is its keep bitmap, run-length coded.

Defined results: a null or empty text is one empty line; keys shorter than ``min_chars`` code points
stay; repeated rows of one document keep the same lines (they are one document); a null doc_id is one
document, after all others; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourlens.llm.common import Stages, hash_pair, line_key, range_blocks

HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Per document that loses lines: doc_id, text_hash, n_dropped, and ``keep``, the runs
    (start, length) of lines that stay."""
    stages = Stages(docs.sparkSession, "lines")
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        lines_of(F.col("text")).alias("lines"))
    rows = split.select("doc_id", "text_hash", F.size("lines").alias("n_lines"),
                        F.posexplode("lines").alias("pos", "line"))
    key = line_key(F.col("line"))
    h1, h2 = hash_pair(F.col("key"))
    hashed = stages.write(rows.select("doc_id", "text_hash", "n_lines", "pos", key.alias("key"))
                          .where(F.length("key") >= min_chars)
                          .select(h1.alias("h1"), h2.alias("h2"),
                                  F.isnull("doc_id").alias("no_id"), "doc_id", "pos",
                                  "text_hash", "n_lines"))
    blocks = range_blocks(stages, hashed, *HASH, "no_id", "doc_id", "pos")
    stages.drop(hashed)

    order = Window.partitionBy("block", *HASH).orderBy("no_id", "doc_id", "pos")
    first = blocks.withColumn("first", F.first(F.struct("no_id", "doc_id")).over(order))
    ends = blocks.groupBy("block").agg(F.min(F.struct(*HASH)).alias("lo"),
                                       F.max(F.struct(*HASH)).alias("hi"))
    edge = ends.select(F.explode(F.array("lo", "hi")).alias("e")).select("e.*").distinct()
    # two hashes per range at most: the bound of both broadcasts
    edge = blocks.select(*HASH, "no_id", "doc_id").join(F.broadcast(edge), HASH).groupBy(*HASH).agg(
        F.min(F.struct("no_id", "doc_id")).alias("edge_first"))
    owner = F.coalesce("edge_first", "first")
    lost = (first.join(F.broadcast(edge), HASH, "left")
            .where(~F.col("doc_id").eqNullSafe(owner["doc_id"]))
            .select("doc_id", "text_hash", "n_lines", "pos").distinct())

    doc = ["doc_id", "text_hash"]
    run = F.col("pos") - F.row_number().over(Window.partitionBy(*doc).orderBy("pos"))
    runs = lost.withColumn("run", run).groupBy(*doc, "run").agg(
        F.min("pos").alias("start"), F.count("*").cast("int").alias("length"),
        F.first("n_lines").alias("n_lines"))
    per_doc = runs.groupBy(*doc).agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("gone"),
        F.sum("length").alias("n_dropped"), F.first("n_lines").alias("n_lines"))

    def kept(i: Column) -> Column:
        last, following = F.get("gone", i - 1), F.get("gone", i)
        start = F.coalesce(last["start"] + last["length"], F.lit(0))
        return F.struct(start.alias("start"),
                        (F.coalesce(following["start"], F.col("n_lines")) - start).alias("length"))

    keep = F.filter(F.transform(F.sequence(F.lit(0), F.size("gone")), kept),
                    lambda r: r["length"] > 0)
    return stages.write(per_doc.select(*doc, "n_dropped", keep.alias("keep")))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines a bitmap keeps; a null bitmap keeps all."""
    lines = lines_of(text)
    left = F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(left, "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left, one row per input row."""
    maps = keep_bitmaps(docs, min_chars).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_dropped", "keep")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.select("doc_id", "text").join(maps.hint("shuffle_hash"), on, "left").select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        kept_text(F.col("text"), F.col("keep")).alias("kept"))
