"""Sharding by extendible hashing: a directory of hash prefixes, split only where a bucket is full.

A row's key is hashed to 64 bits.  Bytes are summed once per prefix of ``STEP`` bits; from those
sums every bucket's bytes at each shorter depth follow.  A bucket is the shortest prefix whose
bytes fit the limit.  Prefixes of ``STEP`` bits that are still too large are summed again
over the next ``STEP`` bits, on their own rows only, until each fits or the bits are used up.

What no bit can split, rows of one key (or one row) above the limit, is an overflow bucket: rows are
chained through it in order of content, and a new shard begins whenever the bytes so far cross
another multiple of the limit.  Only a single row larger than the limit makes a shard too large.

Defined results: a null key is hashed as the text ``null``; a null or empty text has 0 bytes;
repeated rows are kept, each in its shard; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourlens.llm.common import Stages, block_offsets, range_blocks

BITS, STEP = 64, 16


def key_bits(key: Column) -> Column:
    """64 bits of the key's MD5 as a string of 16 hex digits."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, BITS // 4)


def _prefix(bits: Column, depth: Column) -> Column:
    """The first ``depth`` bits, written as 0 and 1."""
    return F.substring(F.lpad(F.conv(bits, 16, 2), BITS, "0"), F.lit(1), depth)


def directory(rows: DataFrame, limit: int, stages: Stages) -> DataFrame:
    """Buckets (prefix, depth, bytes, rows, overflow) of ``rows`` (bits, bytes)."""
    found, left, depth = [], rows.select("bits", "bytes"), 0
    while depth < BITS:
        low, depth = depth, depth + STEP
        cells = left.groupBy(F.substring("bits", 1, depth // 4).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
        full = _prefix(F.rpad("cell", BITS // 4, "0"), F.lit(depth))
        # a cell's bytes belong to each of its prefixes; the whole corpus is prefix '' of depth 0
        tall = cells.select("bytes", "rows", full.alias("full"), F.explode(
            F.sequence(F.lit(low if low == 0 else low + 1), F.lit(depth))).alias("depth"))
        tree = stages.write(tall.groupBy(F.expr("substring(full, 1, depth)").alias("prefix"), "depth").agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        fits = tree.where(F.col("bytes") <= limit)
        parent = tree.where(F.col("bytes") > limit).select(
            F.col("prefix").alias("up"), (F.col("depth") + 1).alias("depth"))
        top = (F.col("depth") == 0) if low == 0 else (F.col("depth") == low + 1)
        leaf = fits.withColumn("up", F.expr("substring(prefix, 1, depth - 1)")).join(
            parent, ["up", "depth"], "left_semi").drop("up")
        found.append(leaf.unionByName(fits.where(top)).distinct().withColumn("overflow", F.lit(False)))
        heavy = tree.where((F.col("depth") == depth) & (F.col("bytes") > limit))
        if heavy.isEmpty():
            break
        if depth == BITS:
            found.append(heavy.withColumn("overflow", F.lit(True)))
            break
        cell = F.expr(f"lower(lpad(conv(prefix, 2, 16), {depth // 4}, '0'))")
        left = rows.select("bits", "bytes").withColumn("cell", F.substring("bits", 1, depth // 4)).join(
            heavy.select(cell.alias("cell")), "cell", "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return stages.write(out)


def shard(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: the key), n_bytes, depth, shard, shard_bytes.

    ``shard`` is the bucket's bit prefix; overflow buckets add ``+`` and a number."""
    stages = Stages(docs.sparkSession, "shard")
    keep = keep or [key]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = stages.write(docs.select(F.struct(*keep).alias("row"), key_bits(F.col(key)).alias("bits"),
                                    F.xxhash64(text).alias("content"), size.alias("bytes")))
    book = directory(rows, limit, stages)
    depths = sorted(r[0] for r in book.select("depth").distinct().collect())   # 65 at most
    tried = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths or [0]]))).withColumn(
        "prefix", _prefix(F.col("bits"), F.col("depth")))
    placed = tried.join(book.select("prefix", "depth", "overflow", F.col("bytes").alias("shard_bytes")),
                        ["prefix", "depth"])
    plain = placed.where("not overflow").select(
        "row.*", F.col("bytes").alias("n_bytes"), "depth", F.col("prefix").alias("shard"), "shard_bytes")
    chained = placed.where("overflow")
    if chained.isEmpty():
        return plain
    blocks = range_blocks(stages, chained.select("row", "bytes", "depth", "prefix", "content"),
                          "prefix", "content", "row")
    # small rows fill shards up to half the limit and one row more; a large row has its own
    large = F.col("bytes") * 2 > limit
    part = F.when(large, F.lit(limit)).otherwise(F.col("bytes"))
    before = block_offsets(blocks.withColumn("large", large), part, ["prefix", "large"])
    run = Window.partitionBy("block", "prefix", "large").orderBy("content", "row")
    inside = F.sum(part).over(run.rowsBetween(Window.unboundedPreceding, -1))
    link = F.when(F.col("large"), (F.col("_in") + F.col("before")) / limit).otherwise(
        (F.col("_in") + F.col("before")) * 2 / limit)
    cut = (blocks.withColumn("large", large).withColumn("_in", F.coalesce(inside, F.lit(0)))
           .join(before, ["prefix", "large", "block"])
           .withColumn("shard", F.concat("prefix", F.when(F.col("large"), "+L").otherwise("+"),
                                         F.floor(link).cast("string"))))
    return plain.unionByName(cut.select(
        "row.*", F.col("bytes").alias("n_bytes"), "depth", "shard",
        F.sum("bytes").over(Window.partitionBy("shard")).alias("shard_bytes")))
