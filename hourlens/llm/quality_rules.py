"""Quality rules with cross-document line frequency.

One pass over the texts measures each document and hashes its normalised lines (stripped, A-Z
lower-cased).  Then, for every host (the documents' source), a line's count is the number of
distinct texts that hold it: exact copies of one text count once.  Lines above the host's limit are
boilerplate and are removed; a document that loses most of its words to them is depleted and
rejected.  The limit is a share of the host's distinct texts, at most ``LINE_MOST`` of them, so that on a hot host a
line on thousands of pages goes as well.

Defined results: a null or empty text has no words and fails the base rule; a null host is a host of its
own; repeated rows get a row each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlens.llm import bytescan as bs
from hourlens.llm.common import Stages, small_batches

MIN_WORDS = 50          # base rule: fewer words fail
MAX_REPEAT = 50         # base rule: percent of words in repeated 3-word windows
LINE_SHARE = 0.05       # a line in more than this share of a host's distinct texts is boilerplate
LINE_MOST = 1000        # ... or in more than so many, on any host
LINE_DOCS = 20          # ... if it is in more than so many
DEPLETED = 50           # percent of words lost to boilerplate above which a document goes

LETTER = bs.NOT_SPACE & ((np.arange(256) & 0xC0) != 0x80)    # first bytes of the code points in words
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

MEASURED = ("doc_id {id}, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
            "n_dup_lines long, n_repeat_words long, lines array<struct<line:long,words:int>>")


def _repeated_words(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per document, its words inside 3-word windows that occur twice or more in it."""
    out = np.zeros(len(offs) - 1, np.int64)
    g = bs.window_sums(h, 3)
    if not len(g):
        return out
    doc = bs.segment_ids(offs)
    at = np.flatnonzero(doc[:len(g)] == doc[2:])
    key = bs.mix(bs.mix(g[at]) + doc[at].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.append(same, False) | np.append(False, same)
    hit = np.zeros(len(h), bool)
    for k in range(3):
        hit[at[order[twice]] + k] = True
    np.add.at(out, doc[hit], 1)
    return out


def _lines(part, own, starts, ends, offs):
    """Lines that hold a word: document, first and past-last word, first and past-last byte."""
    none = np.empty(0, np.int64)
    if not len(starts):
        return none, none, none, none, none
    stops = np.flatnonzero(part == 10)
    doc, row = bs.segment_ids(offs), np.searchsorted(stops, starts)
    at = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])))
    to = np.append(at[1:], len(starts))
    d, r = doc[at], row[at]
    edge = np.concatenate([[-1], stops, [len(part)]])
    return d, at, to, np.maximum(edge[r] + 1, own[d]), np.minimum(edge[r + 1], own[d + 1])


def _bytes_of(part: np.ndarray, own: np.ndarray, member: np.ndarray) -> np.ndarray:
    """How many bytes of each document belong to a class; a long document is counted piece by piece."""
    if len(part) > bs.PIECE:                    # one document
        return np.array([sum(np.count_nonzero(member[part[a:a + bs.PIECE]]) for a in range(0, len(part), bs.PIECE))])
    total = np.concatenate([[0], np.cumsum(member[part])])
    return total[own[1:]] - total[own[:-1]]


def _run(buf, bounds, i, j, h, offs, starts, ends):
    """Measures of documents i to j of a batch."""
    lo, hi = bounds[i], bounds[j]
    part, own = buf[lo:hi], bounds[i:j + 1] - lo
    starts, ends = starts - lo, ends - lo
    doc, at, to, first, last = _lines(part, own, starts, ends, offs)
    if hi - lo <= bs.PIECE:
        whole = bs.hash_words(part, first, last)
        norm = bs.hash_words(bs.LOWER[part], starts[at], ends[to - 1])
    else:                               # line by line: nothing as long as the text
        whole = np.array([xxhash.xxh3_64_intdigest(part[a:b]) for a, b in zip(first, last)], np.uint64)
        norm = np.array([line_hash(part[a:b]) for a, b in zip(starts[at], ends[to - 1])], np.uint64)
    order = np.lexsort((whole, doc))
    again = (whole[order][1:] == whole[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    dup = np.bincount(doc[order][1:][again], minlength=j - i)
    # words by document and normalised line
    order = np.lexsort((norm, doc))
    d, k, w = doc[order], norm[order], (to - at)[order]
    begin = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))[:len(d)])
    total = np.add.reduceat(w, begin) if len(begin) else np.empty(0, np.int64)
    lines = np.bincount(d[begin], minlength=j - i)
    return (np.diff(offs), _bytes_of(part, own, LETTER), _bytes_of(part, own, SYMBOL), dup,
            _repeated_words(h, offs), lines, k[begin], total)


def line_hash(raw: np.ndarray) -> int:
    """Hash of one stripped line."""
    return int(bs.hash_words(bs.LOWER[raw], np.array([0]), np.array([len(raw)]))[0])


def measure(docs: DataFrame) -> DataFrame:
    """Base measures and hashed lines of every document (doc_id, host, text)."""
    def scan(batches):
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            parts = [_run(buf, bounds, *run) for run in bs.scan_words(buf, bounds, bs.NOT_SPACE, False)]
            cols = [np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*parts)] or \
                [np.empty(0, np.int64)] * 8
            lines = pa.StructArray.from_arrays(
                [pa.array(cols[6].astype(np.uint64).view(np.int64)), pa.array(cols[7], pa.int32())],
                ["line", "words"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["host"], batch["text_hash"],
                 *[pa.array(c, pa.int64()) for c in cols[:5]],
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(cols[5])), pa.int32()), lines)],
                ["doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                 "n_repeat_words", "lines"])

    kind = dict(docs.dtypes)["doc_id"]
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "host", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        scan, MEASURED.format(id=kind))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT)


def judge(docs: DataFrame, share: float = LINE_SHARE, least: int = LINE_DOCS, depleted: int = DEPLETED,
          most: int = LINE_MOST, copies: bool = False) -> tuple[DataFrame, DataFrame]:
    """Verdicts (measures, text_hash, host, lost words, base_failed, kept), one per input row,
    and the removed lines: text_hash, host, boilerplate (line hashes).

    A line goes from a host if more than ``least`` of its documents hold it and more than ``share`` of them or more
    than ``most``.  Exact copies of a text count once unless ``copies`` are documents of their own."""
    stages = Stages(docs.sparkSession, "quality")
    measured = stages.write(measure(docs))
    texts = measured.select("host", "text_hash", F.explode("lines").alias("l")).select(
        "host", "text_hash", "l.line", "l.words")
    # a row lists each of its lines once
    counted = texts.select("host", "line", "text_hash")
    counts = (counted if copies else counted.distinct()).groupBy("host", "line").agg(
        F.count("*").alias("n")).where(F.col("n") > least)
    held = measured.select("host", "text_hash")
    sizes = (held if copies else held.distinct()).groupBy("host").agg(
        F.count("*").alias("host_texts"))
    frequent = stages.write(counts.withColumnRenamed("host", "_h").join(
        sizes, F.col("_h").eqNullSafe(F.col("host"))).where(
        F.col("n") > F.least(F.col("host_texts") * share, F.lit(float(most))))
        .select(F.col("host").alias("_host"), F.col("line").alias("_line")))
    lost = texts.join(frequent, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")))
    lost = stages.write(lost.groupBy("host", "text_hash", "line").agg(F.max("words").alias("words"))
                        .groupBy("host", "text_hash").agg(
        F.sum("words").alias("lost_words"), F.collect_list("line").alias("boilerplate")))
    found = lost.select(F.col("host").alias("_host"), F.col("text_hash").alias("_hash"), "lost_words")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    out = measured.drop("lines").join(
        found, F.col("host").eqNullSafe(F.col("_host")) & (F.col("text_hash") == F.col("_hash")), "left")
    out = out.drop("_host", "_hash").withColumn("lost_words", F.coalesce("lost_words", F.lit(0)))
    gone = F.col("lost_words") * 100 > F.col("n_words") * depleted
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~gone), lost.drop("lost_words")


def without_lines(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``text`` without the lines whose hash is in ``boilerplate`` (may be null)."""
    def strip(batches):
        for batch in batches:
            texts = []
            for text, bad in zip(batch["text"].to_pylist(), batch["boilerplate"].to_pylist()):
                if text is not None and bad:
                    drop, left = {v & (2**64 - 1) for v in bad}, []
                    for line in text.split("\n"):
                        raw = np.frombuffer(line.encode().strip(b" \t\n\x0b\x0c\r"), np.uint8)
                        if not len(raw) or line_hash(raw) not in drop:
                            left.append(line)
                    text = "\n".join(left)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in keep] + [pa.array(texts, pa.string())], [*keep, "text"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes) + ", text string"
    return rows.select(*keep, "text", "boilerplate").mapInArrow(strip, schema)
