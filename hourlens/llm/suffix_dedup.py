"""Suffix-array de-duplication of byte strings, exact, over the whole collection.

A byte goes if a string of ``size`` bytes that covers it also starts earlier in the collection.

1. Anchors.  Every ``size``-byte window has one anchor, its smallest ``GRAM``-byte gram by hash, so
   equal windows have equal anchors at the same place.  Neighbouring windows mostly share theirs: a
   maximal run of windows with one anchor is a stretch, some dozens of windows long.
2. Equal stretches.  Of equal stretches all but the first are repeats as they stand.  Most of it is settled
   inside the scanning task, so a text copied a million times reaches the shuffle once per batch.
3. Unequal stretches with the same anchor gram can share some windows.  Their bytes are fetched as
   fragments, brought together by anchor, and a suffix array of the fragments is built column-wise:
   each round puts one more symbol of every fragment, last to first, before the suffixes sorted so far; a
   stable counting sort by that symbol (the collection's Burrows-Wheeler transform, read in
   order) gives their order.  Fragments none of whose windows has a rolling hash that occurs again
   are left out beforehand.  Neighbours in the array with a common prefix of ``size`` bytes are one class, and
   all but its earliest window are repeats.

The construction is column-wise over fragments, not over whole documents: rounds then number at most a
fragment's length, not the longest document's, and the sorted columns are arrays of one bounded block
of fragments instead of files of the whole collection.  A crowd of fragments around one anchor that is larger
than a block is settled by the hash of each window instead, pre-aggregated, with the same result.

Defined results: a null or empty text has no bytes and loses none; documents are ordered by doc_id, null last,
rows that share a doc_id by their text's hash; identical rows are one document and each gets its row; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlens.llm import bytescan as bs
from hourlens.llm.common import Stages, small_batches

SIZE, GRAM = 100, 24
BLOCK = 1 << 20         # bytes of fragments sorted at once
CROWD = 4096            # stretches around one anchor that still go into one block
POS = np.uint64(20)     # bits for a place inside one piece
ORDER = ["no_id", "doc_id", "text_hash"]


def stretches(part: np.ndarray, own: np.ndarray, size: int, gram: int):
    """Stretches of a piece of text: document, first window, windows, anchor hash, content hash."""
    none = np.empty(0, np.int64)
    if len(part) < size:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    pw, inv = bs.powers(len(part))
    c = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(bs.BYTE[part] * pw[:-1], out=c[1:])
    g = bs.mix((c[gram:] - c[:-gram]) * inv[:len(part) - gram + 1])
    low = (g >> POS << POS) | np.arange(len(g), dtype=np.uint64)
    reach, least = 1, low                               # smallest of ``reach`` grams from each place
    span = size - gram + 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[:len(part) - size + 1], least[span - reach:span - reach + len(part) - size + 1])
    at = (least & np.uint64((1 << int(POS)) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(own) - 1), np.diff(own))
    p = np.flatnonzero(doc[:len(at)] == doc[size - 1:])         # windows that stay in a document
    if not len(p):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor, d = at[p], doc[p]
    begin = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (d[1:] != d[:-1])))
    end = np.append(begin[1:], len(p)) - 1
    first, last = p[begin], p[end] + size
    content = bs.mix((c[last] - c[first]) * inv[first] + (last - first).astype(np.uint64)) + (
        anchor[begin] - first).astype(np.uint64)
    return d[begin], first, end - begin + 1, g[anchor[begin]], bs.mix(content)


def _pieces(buf, bounds, size):
    """(first document, bytes, bounds, place in the document) of pieces of a batch."""
    for i, j in bs.groups(bounds):
        lo, hi = bounds[i], bounds[j]
        if hi - lo <= bs.PIECE:
            yield i, buf[lo:hi], bounds[i:j + 1] - lo, 0
        else:
            for at in range(lo, hi - size + 1, bs.PIECE - size + 1):
                part = buf[at:min(at + bs.PIECE, hi)]
                yield i, part, np.array([0, len(part)]), at - lo


def _order(no_id: np.ndarray, doc_id: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
    """Rank of each row's document; equal rows share a rank."""
    rank = np.lexsort((text_hash, doc_id, no_id))
    a, b = rank[1:], rank[:-1]
    step = (no_id[a] != no_id[b]) | (doc_id[a] != doc_id[b]) | (text_hash[a] != text_hash[b])
    out = np.empty(len(rank), np.int64)
    out[rank] = np.append(0, np.cumsum(step))[:len(rank)]
    return out


def _ids(batch):
    ids = batch["doc_id"]
    return (ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False),
            batch["text_hash"].to_numpy())


def scan(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """Stretches of all documents; those that repeat an earlier one of the same batch are marked."""
    def run(batches):
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            found = []
            for i, part, own, shift in _pieces(buf, bounds, size):
                d, p, n, a, s = stretches(part, own, size, gram)
                found.append((d + i, p - own[d] + shift if len(d) else p, n, a, s))
            doc, start, n, anchor, content = (np.concatenate(x) for x in zip(*found)) if found else (
                np.empty(0, np.int64),) * 5
            place = (_order(*_ids(batch))[doc] << 40) | start
            order = np.lexsort((place, content))
            c, at = content[order], place[order]
            new = np.append(True, c[1:] != c[:-1])[:len(c)]
            lead = at[np.flatnonzero(new)][np.cumsum(new) - 1] if len(c) else at
            again = np.empty(len(c), bool)
            again[order] = at > lead
            rows = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(_ids(batch)[0][doc], pa.bool_()), batch["doc_id"].take(rows),
                 batch["text_hash"].take(rows), pa.array(again, pa.bool_()),
                 pa.array(anchor.astype(np.uint64).view(np.int64)),
                 pa.array(content.astype(np.uint64).view(np.int64)),
                 pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                [*ORDER, "again", "anchor", "content", "start", "n"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"no_id boolean, doc_id {kind}, text_hash long, again boolean, "
                                "anchor long, content long, start int, n int")


def column_sort(text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Start of every suffix of the strings ``text[first:last]``, in suffix order.

    ``text`` holds the strings one after the other.  ``sorted_`` lists the suffixes of at most j
    symbols; the symbols before them, in that order, are the collection's transform."""
    ends = last.astype(np.int64)
    alive = np.zeros(len(text) + 1, bool)           # places that have a symbol before them
    for a, b in zip(first, last):
        alive[a + 1:b + 1] = True
    # the empty suffix of string k stands for its end; strings lie apart by one separator
    sorted_ = ends
    for _ in range(int((last - first).max(initial=0))):
        longer = sorted_[alive[sorted_]]
        symbol = text[longer - 1]
        sorted_ = np.concatenate([ends, longer[np.argsort(symbol, kind="stable")] - 1])
    return sorted_[len(ends):]


def _joined(fragments: list[bytes]):
    """Fragments one after the other, a separator after each; where they start and end."""
    text = np.frombuffer(b"\0".join(fragments) + b"\0", np.uint8)
    length = np.array([len(f) for f in fragments])
    first = np.cumsum(length + 1) - length - 1
    return text, first, first + length


def with_like_windows(fragments: list[bytes], size: int) -> np.ndarray:
    """Which fragments hold a window whose rolling hash occurs again; the others repeat nothing."""
    text, first, last = _joined(fragments)
    h = bs.window_sums(bs.BYTE[text], size)
    owner = np.repeat(np.arange(len(fragments)), last - first + 1)
    at = np.arange(len(h))
    at = at[last[owner[at]] - at >= size]
    order = np.argsort(h[at], kind="stable")
    same = h[at][order][1:] == h[at][order][:-1]
    twice = np.append(same, False) | np.append(False, same)
    return np.unique(owner[at[order[twice]]])


def repeated_windows(fragments: list[bytes], place: np.ndarray, size: int):
    """(fragment, window) of every window that also starts earlier; ``place`` orders the fragments'
    first windows, and a window's place is that plus its number."""
    text, first, last = _joined(fragments)
    length = last - first
    owner = np.repeat(np.arange(len(fragments)), length + 1)
    array = column_sort(text, first, last)
    array = array[last[owner[array]] - array >= size]               # suffixes that hold a window
    if len(array) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(text, size)
    same = np.empty(len(array) - 1, bool)
    for k in range(0, len(same), 1 << 16):
        a = array[k:k + (1 << 16) + 1]
        same[k:k + (1 << 16)] = (windows[a[1:]] == windows[a[:-1]]).all(axis=1)
    begin = np.flatnonzero(np.append(True, ~same))
    where = place[owner[array]] + array - first[owner[array]]
    earliest = np.repeat(np.minimum.reduceat(where, begin), np.diff(np.append(begin, len(array))))
    hit = array[where > earliest]
    return owner[hit], hit - first[owner[hit]]


def _spans(doc: np.ndarray, place: np.ndarray, size: int):
    """Runs of window starts, by document: index of the first row, start, end of the bytes."""
    order = np.lexsort((place, doc))
    d, p = doc[order], place[order]
    begin = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (p[1:] > p[:-1] + size))[:len(d)])
    end = np.append(begin[1:], len(d)) - 1
    return order[begin], p[begin], p[end[:len(begin)]] + size


def _fragment_blocks(frags: DataFrame, kind: str, size: int) -> DataFrame:
    """Spans of repeated windows among fragments that share an anchor."""
    def settle(held):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        no_id, doc_id, text_hash = _ids(rows)
        start = rows["start"].to_numpy().astype(np.int64)
        rank = _order(no_id, doc_id, text_hash)
        pieces = rows["bytes"].to_pylist()
        like = with_like_windows(pieces, size)
        owner = window = np.empty(0, np.int64)
        if len(like):
            owner, window = repeated_windows([pieces[k] for k in like], ((rank << 40) | start)[like], size)
            owner = like[owner]
        which, a, b = _spans(rank[owner], start[owner] + window, size)
        take = pa.array(owner[which], pa.int64())
        return pa.RecordBatch.from_arrays(
            [rows["doc_id"].take(take), rows["text_hash"].take(take),
             pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["doc_id", "text_hash", "start", "end"])

    def run(batches):
        held, bulk, last = [], 0, None
        for batch in batches:
            anchor = batch["anchor"].to_numpy()
            cuts = np.flatnonzero(np.diff(anchor)) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(anchor))):
                if a == b:
                    continue
                if anchor[a] != last and bulk > BLOCK:
                    yield settle(held)
                    held, bulk = [], 0
                last = anchor[a]
                held.append(batch.slice(a, b - a))
                bulk += int(pa.compute.sum(pa.compute.binary_length(held[-1]["bytes"])).as_py())
        if held:
            yield settle(held)

    return frags.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        run, f"doc_id {kind}, text_hash long, start int, end int")


def _crowd_windows(frags: DataFrame, kind: str, size: int, stages: Stages) -> DataFrame:
    """The same for anchors with too many fragments for one block: by the hash of each window."""
    def run(batches):
        for batch in batches:
            row, window, h1, h2 = [], [], [], []
            for k, f in enumerate(batch["bytes"]):
                f = np.frombuffer(f.as_buffer(), np.uint8)
                for w in range(len(f) - size + 1):
                    d = hashlib.blake2b(f[w:w + size], digest_size=16).digest()
                    row.append(k)
                    window.append(w)
                    h1.append(int.from_bytes(d[:8], "little", signed=True))
                    h2.append(int.from_bytes(d[8:], "little", signed=True))
            at = pa.array(row, pa.int64())
            start = batch["start"].to_numpy()[np.array(row, np.int64)] + np.array(window, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch[c].take(at) for c in ORDER] + [
                    pa.array(start, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())],
                [*ORDER, "start", "h1", "h2"])

    windows = stages.write(frags.mapInArrow(
        run, f"no_id boolean, doc_id {kind}, text_hash long, start int, h1 long, h2 long"))
    me = F.struct(*ORDER, "start")
    first = windows.groupBy("h1", "h2").agg(F.min(me).alias("lead"))
    return windows.join(first, ["h1", "h2"]).where(me > F.col("lead")).select(
        "doc_id", "text_hash", "start", (F.col("start") + size).alias("end"))


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, text_hash and ``spans`` (start, end), not yet merged, of documents that lose bytes."""
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "suffix")
    kind = dict(docs.dtypes)["doc_id"]
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    scanned = stages.write(scan(own, size, gram))

    # counts per anchor and first places per content are reduced before they are shuffled, and joined back, so the
    # stretches of one anchor never have to meet in one task
    place = [*ORDER, "start"]
    met = scanned.where("not again")
    anchors = stages.write(met.groupBy("anchor").agg(
        F.count("*").alias("crowd"), F.min("content").alias("lo"), F.max("content").alias("hi")).where("crowd > 1"))
    around = stages.write(met.join(anchors, "anchor").select(
        *place, "n", "anchor", "content", "crowd", (F.col("lo") != F.col("hi")).alias("mixed")))
    me = F.struct(*place)
    leads = stages.write(around.groupBy("anchor", "content").agg(F.min(me).alias("lead"), F.count("*").alias("alike"))
                         .where("alike > 1").drop("alike"))
    later = F.coalesce(me > F.col("lead"), F.lit(False))
    settled = stages.write(around.join(leads, ["anchor", "content"], "left").withColumn("later", later).where(
        "later or mixed").select(*place, "n", "anchor", "later", "crowd"))
    stages.drop(anchors, around, leads)
    whole = (F.col("start") + F.col("n") - 1 + size).alias("end")
    spans = scanned.where("again").select("doc_id", "text_hash", "start", whole).unionByName(
        settled.where("later").select("doc_id", "text_hash", "start", whole))

    asked = settled.where("not later").groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set(F.struct("anchor", "start", "n", "crowd")).alias("asked"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))

    def cut(batches):
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            asked = batch["asked"]
            doc = np.repeat(np.arange(len(asked)), np.diff(asked.offsets.to_numpy()))
            flat = asked.flatten()
            start, n = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "n"))
            low = bounds[doc] + start
            pieces = [buf[a:b].tobytes() for a, b in zip(low, low + n - 1 + size)]
            at = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(_ids(batch)[0][doc], pa.bool_()), batch["doc_id"].take(at),
                 batch["text_hash"].take(at), flat.field("start"), flat.field("anchor"),
                 flat.field("crowd"), pa.array(pieces, pa.binary())],
                [*ORDER, "start", "anchor", "crowd", "bytes"])

    laid = own.join(asked.hint("shuffle_hash"), same).select("doc_id", "text_hash", "text", "asked")
    frags = stages.write(laid.mapInArrow(
        cut, f"no_id boolean, doc_id {kind}, text_hash long, start int, anchor long, crowd long, "
             "bytes binary").distinct())
    spans = spans.unionByName(_fragment_blocks(frags.where(F.col("crowd") <= crowd), kind, size))
    spans = spans.unionByName(_crowd_windows(frags.where(F.col("crowd") > crowd), kind, size, stages))
    out = stages.write(spans.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")))
    stages.drop(scanned, settled, frags)
    return out


def _cut_runs(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    begin = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return np.stack([spans[begin, 0], reach[np.append(begin[1:], len(spans)) - 1]], axis=1)


def dedup_bytes(docs: DataFrame, size: int = SIZE, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, runs (removed byte ranges) and ``kept``, the bytes that are left."""
    kind = dict(docs.dtypes)["doc_id"]
    found = repeated_spans(docs, size, gram, crowd).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    laid = docs.select("doc_id", "text").join(found.hint("shuffle_hash"), same, "left").select(
        "doc_id", "text", "spans")

    def remove(batches):
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            spans = batch["spans"]
            flat, offs = spans.flatten(), np.append(0, np.cumsum(
                pa.compute.fill_null(pa.compute.list_value_length(spans), 0).to_numpy()))
            pairs = np.stack([flat.field(c).to_numpy() for c in ("start", "end")], axis=1).astype(np.int64)
            runs, counts, kept = [np.empty((0, 2), np.int64)], [], []
            for k in range(len(bounds) - 1):
                raw = buf[bounds[k]:bounds[k + 1]]
                cut = _cut_runs(pairs[offs[k]:offs[k + 1]])
                runs.append(cut)
                counts.append(len(cut))
                keep = np.concatenate([[0], cut.ravel(), [len(raw)]]).reshape(-1, 2)
                kept.append(b"".join([raw[a:b].tobytes() for a, b in keep]))
            runs = np.concatenate(runs)
            places = pa.array(np.append(0, np.cumsum(np.array(counts, np.int64))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(bounds)),
                 pa.ListArray.from_arrays(places, pa.StructArray.from_arrays(
                     [pa.array(runs[:, 0], pa.int32()), pa.array(runs[:, 1], pa.int32())], ["start", "end"])),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "runs", "kept"])

    return laid.mapInArrow(remove, f"doc_id {kind}, n_bytes long, "
                                   "runs array<struct<start:int,end:int>>, kept binary")
