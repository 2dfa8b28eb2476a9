"""Source divergence audit: how far each source's words are from other sources' and from its language's.

1. A first reading counts, per language, the texts that hold each term; the terms kept are sorted by range and
   numbered in UTF-8 order (their ordinals).
2. Ranges of at most ``PART_BYTES`` of terms become minimal acyclic transducers, each built in a task of its own.
   They are broadcast in passes of at most ``PASS_BYTES`` (one pass for millions of terms), whose
   size is known before; a pass lets the texts of its languages stream through the transducers, which drop all other
   words and turn the rest into ordinals, counted by (language, source).  A pass is given up before the next is read.
3. Pairs of sources are compared in cells: ``CELL_TERMS`` terms by two tiles of ``TILE`` sources.  A cell is
   a bounded matrix, terms that a source lacks included, and returns one sum per pair of sources, so neither a frequent
   term nor a language with many sources is one task's work.  Ordinals break ties of the term ranking.

All arithmetic is on integers: shares are p = 1 + floor(10^9 (count + 1) / (N + V)).

Defined results: null text, language and source count as ''; every row is a text of its own, repeated rows and
ids included; a group without words has all its counts 0; a language that keeps no term gives pairs of
value 0 and no terms; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens.llm import bytescan as bs
from hourlens.llm import transducer
from hourlens.llm.common import Stages, block_offsets, range_blocks, small_batches

PART_BYTES = 1 << 21        # terms of one transducer, 16 bytes added for each
PASS_BYTES = 1 << 25        # transducers that one pass broadcasts
CELL_TERMS, TILE = 4096, 32

LETTERS = np.zeros(256, bool)               # terms [^\x00-\x40\x5B-\x60\x7B-\x7F]+, lower-cased
LETTERS[97:123] = LETTERS[128:] = True
SPELL = np.where(LETTERS[bs.LOWER], bs.LOWER, 32).astype(np.uint8)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])


def document_counts(texts: DataFrame) -> DataFrame:
    """lang, term and docs, the texts that hold it; one row or more for a term, to be summed."""
    def count(batches):
        for batch in batches:
            terms, words, offs = bs.word_numbers(batch["text"], SPELL)
            if not len(words):
                continue
            lang = batch["lang"].dictionary_encode()
            once = np.unique(bs.segment_ids(offs) * len(terms) + words)
            by = lang.indices.to_numpy().astype(np.int64)[once // len(terms)]
            found, docs = np.unique(by * len(terms) + once % len(terms), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(found // len(terms))),
                 terms.take(pa.array(found % len(terms))).cast(pa.string()), pa.array(docs)],
                ["lang", "term", "docs"])

    return texts.select("text", "lang").mapInArrow(count, "lang string, term string, docs long")


def kept_terms(texts: DataFrame, least: int, stages: Stages) -> DataFrame:
    """lang, term, ordinal (in the language, UTF-8 order) and part (the transducer it goes to)."""
    kept = document_counts(texts).groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(
        F.col("docs") >= least).select("lang", "term")
    blocks = range_blocks(stages, kept, "lang", "term")
    weight = F.octet_length("term") + F.lit(16)
    starts = block_offsets(blocks, F.lit(1), ["lang"]).withColumnRenamed("before", "terms").join(
        block_offsets(blocks, weight, ["lang"]).withColumnRenamed("before", "bytes"), ["lang", "block"])
    inside = Window.partitionBy("block", "lang").orderBy("term")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = blocks.withColumn("n", F.row_number().over(inside) - 1).withColumn(
        "b", F.sum(weight).over(upto) - weight)
    out = stages.write(numbered.join(starts, ["lang", "block"]).select(
        "lang", "term", (F.col("terms") + F.col("n")).alias("ordinal"),
        F.expr(f"(bytes + b) div {PART_BYTES}").alias("part")))
    stages.drop(blocks)
    return out


def transducers(vocabulary: DataFrame) -> DataFrame:
    """lang, part, first term, its ordinal, edges and their size in bytes."""
    def make(group: pa.Table) -> pa.Table:
        group = group.sort_by("ordinal")
        terms = [t.encode() for t in group["term"].to_pylist()]
        edges = transducer.build(terms).tobytes()
        return pa.table({"lang": group["lang"][:1], "part": group["part"][:1], "first": pa.array([terms[0]], pa.binary()),
                         "ordinal": group["ordinal"][:1], "bytes": [len(edges)], "edges": pa.array([edges], pa.binary())})

    return vocabulary.groupBy("lang", "part").applyInArrow(
        make, "lang string, part long, first binary, ordinal long, bytes long, edges binary")


def recount(texts: DataFrame, parts: DataFrame, stages: Stages) -> DataFrame:
    """lang, source, ordinal and count of every kept term that a source holds."""
    spark, passes, room = texts.sparkSession, [], 0
    for row in parts.select("lang", "part", "bytes").orderBy("lang", "part").collect():     # one row per part
        if not passes or room + row["bytes"] > PASS_BYTES:
            passes.append([])
            room = 0
        passes[-1].append((row["lang"], row["part"]))
        room += row["bytes"]
    kind = "lang string, source string, ordinal long, count long"
    out = []
    for keys in passes:
        (low, first), (high, last) = keys[0], keys[-1]
        lang, part = F.col("lang"), F.col("part")
        own = parts.where(((lang > low) | ((lang == low) & (part >= first)))
                          & ((lang < high) | ((lang == high) & (part <= last))))
        held = spark.sparkContext.broadcast(transducer.Lookup(
            [(r["lang"], bytes(r["first"]), r["ordinal"], np.frombuffer(r["edges"], transducer.EDGE))
             for r in own.orderBy("lang", "part").collect()]))
        read = texts if len(passes) == 1 else texts.where(F.col("lang").between(low, high))
        out.append(stages.write(read.mapInArrow(_counter(held), kind).groupBy("lang", "source", "ordinal").agg(
            F.sum("count").alias("count"))))
        held.destroy()
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], kind)


def _counter(held):
    def count(batches):
        lookup = held.value
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            buf = bs.LOWER[buf]
            starts, ends = bs.find_words(buf, bounds, LETTERS)
            text = np.searchsorted(bounds, starts, "right") - 1
            lang, source = (batch[c].dictionary_encode() for c in ("lang", "source"))
            by_lang, by_source = (x.indices.to_numpy().astype(np.int64) for x in (lang, source))
            for code, name in enumerate(lang.dictionary.to_pylist()):
                mine = np.flatnonzero(by_lang[text] == code)
                found = lookup.ordinals(name, buf, starts[mine], ends[mine])
                known = found >= 0
                if not known.any():
                    continue
                wide = int(found.max()) + 1
                key, n = np.unique(by_source[text[mine[known]]] * wide + found[known], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(key), pa.string()), source.dictionary.take(pa.array(key // wide)),
                     pa.array(key % wide), pa.array(n)], ["lang", "source", "ordinal", "count"])

    return count


def share(count: Column, words: Column, terms: Column) -> Column:
    """p = 1 + floor(10^9 (count + 1) / (words + terms)), exact for any count."""
    up = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", up, (words + terms).cast("decimal(20,0)")) + 1


def pair_sums(entries: DataFrame, sources: DataFrame, stages: Stages) -> DataFrame:
    """lang, a, b (numbers of two sources of a language), value: f summed over all kept terms.

    ``entries``: lang, at (the source's number), ordinal, p; ``sources``: lang, at, zero (p of a term without
    count), terms, tiles."""
    kinds = sources.select("lang", "at", "terms", "zero", F.floor(F.col("at") / TILE).alias("tile"), "tiles").where(
        "terms > 0")
    # a source's rows go to the cells of its tile with every tile
    cells = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    heads = kinds.withColumn("other", cells).withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(terms - 1) div {CELL_TERMS}")))).select(
        "lang", "block", "tile", "other", "at", "terms", F.lit(-1).cast("long").alias("ordinal"), F.col("zero").alias("p"))
    body = entries.join(kinds.drop("zero"), ["lang", "at"]).withColumn("other", cells).select(
        "lang", F.expr(f"ordinal div {CELL_TERMS}").alias("block"), "tile", "other", "at", "terms", "ordinal", "p")
    rows = heads.unionByName(body).withColumn("low", F.least("tile", "other")).withColumn(
        "high", F.greatest("tile", "other")).drop("tile", "other")

    def compare(group: pa.Table) -> pa.Table:
        at, ordinal, p = (group[c].to_numpy() for c in ("at", "ordinal", "p"))
        block, terms = group["block"][0].as_py(), group["terms"][0].as_py()
        head = ordinal < 0
        names = np.sort(at[head])
        order = np.argsort(at[head])
        matrix = np.repeat(p[head][order][:, None], min(CELL_TERMS, terms - block * CELL_TERMS), axis=1)
        matrix[np.searchsorted(names, at[~head]), ordinal[~head] - block * CELL_TERMS] = p[~head]
        across = group["low"][0].as_py() != group["high"][0].as_py()
        a, b, value = [], [], []
        for i, row in enumerate(matrix):
            step = row - matrix
            sums = (step * step // matrix).sum(axis=1)
            fit = (names // TILE != names[i] // TILE) if across else names != names[i]
            a.append(np.full(int(fit.sum()), names[i]))
            b.append(names[fit])
            value.append(sums[fit])
        n = sum(map(len, a))
        return pa.table({"lang": pa.array([group["lang"][0].as_py()] * n, pa.string()),
                         "a": np.concatenate(a), "b": np.concatenate(b), "value": np.concatenate(value)})

    return rows.groupBy("lang", "block", "low", "high").applyInArrow(
        compare, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 3, ranks: int = 200) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank.

    ``pair``: every other source of the language with the sum of f = floor((p - q)^2 / q) over its kept terms.
    ``term``: the ``ranks`` terms that a source uses more than its language and that add most."""
    spark = docs.sparkSession
    small_batches(spark)
    stages, texts = Stages(spark, "source-audit"), _texts(docs)
    vocabulary = kept_terms(texts, least, stages)
    parts = stages.write(transducers(vocabulary))
    counts = recount(texts, parts, stages)
    stages.drop(parts)

    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"))
    words = counts.groupBy("lang", "source").agg(F.sum("count").alias("words"))
    by_lang = Window.partitionBy("lang")
    sources = stages.write(
        texts.groupBy("lang", "source").agg(F.lit(1)).select("lang", "source")
        .join(words, ["lang", "source"], "left").join(sizes, "lang", "left")
        .fillna(0, ["words", "terms"])
        .withColumn("at", F.row_number().over(by_lang.orderBy("source")).cast("long") - 1)
        .withColumn("tiles", F.expr(f"(count(*) OVER (PARTITION BY lang) + {TILE - 1}) div {TILE}"))
        .withColumn("all_words", F.sum("words").over(by_lang))
        .withColumn("zero", F.when(F.col("terms") > 0, share(F.lit(0), F.col("words"), F.col("terms")))))
    entries = stages.write(counts.join(sources, ["lang", "source"]).select(
        "lang", "at", "ordinal", "count", share(F.col("count"), F.col("words"), F.col("terms")).alias("p")))

    sums = pair_sums(entries.select("lang", "at", "ordinal", "p"), sources, stages)
    one = sources.select("lang", "source", F.col("at").alias("a"))
    two = sources.select("lang", F.col("source").alias("item"), F.col("at").alias("b"))
    pairs = one.join(two, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(ranked).alias("rank"))

    whole = entries.groupBy("lang", "ordinal").agg(F.sum("count").alias("count")).join(
        sources.groupBy("lang").agg(F.first("all_words").alias("all_words"), F.first("terms").alias("terms")), "lang")
    whole = whole.select("lang", "ordinal", share(F.col("count"), F.col("all_words"), F.col("terms")).alias("q"))
    above = entries.join(whole, ["lang", "ordinal"]).where("p > q").select(
        "lang", "at", "ordinal", F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy("lang", "at").orderBy(F.desc("value"), "ordinal")
    top = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    terms = top.join(vocabulary, ["lang", "ordinal"]).join(sources, ["lang", "at"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
