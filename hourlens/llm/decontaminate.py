"""Benchmark decontamination: a broadcast set of test n-grams against every window of the corpus.

The items' windows (``n`` consecutive words; an item of fewer words is one window) are hashed into a
set.  Its size is counted first: up to ``MAX_WINDOWS`` windows are broadcast at once, a larger set is
dealt into as many parts, each scanned in turn and the parts' hits united.  A task rolls a hash over
each document's words, looks windows up in a bit table, then in the sorted hashes, and
compares the words of what is left, so no hash collision marks a document.

Defined results: null or empty texts have no words and no hits; an item without words has no
window; items with one id count once, a null id counts but is not printed; repeated rows get their
own results; empty tables give no hits or no rows; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlens.llm import bytescan as bs
from hourlens.llm.common import Stages, small_batches

MAX_WINDOWS = 500_000
SCAN = ("doc_id {id}, text_hash long, n_words long, spans array<struct<start:int,end:int>>, "
        "items array<{item}>")


def _window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    return bs.mix(bs.window_sums(h, n) + np.uint64(n))


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """(item_id, size, hash, words) of every window of every item."""
    def windows(batches):
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            ids, rows = batch["item_id"], []
            for i, j, h, offs, starts, ends in bs.scan_words(buf, bounds, bs.ALNUM, True):
                for d in range(j - i):
                    a, b = offs[d], offs[d + 1]
                    size = min(n, b - a)
                    if not size:
                        continue
                    words = [bytes(bs.LOWER[buf[s:e]]) for s, e in zip(starts[a:b], ends[a:b])]
                    for k, v in enumerate(_window_hashes(h[a:b], size).view(np.int64)):
                        rows.append((i + d, size, int(v), b" ".join(words[k:k + size])))
            at, size, key, words = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(size, pa.int32()),
                 pa.array(key, pa.int64()), pa.array(words, pa.binary())],
                ["item_id", "size", "hash", "words"])

    kind = dict(items.dtypes)["item_id"]
    return items.select("item_id", "text").mapInArrow(
        windows, f"item_id {kind}, size int, hash long, words binary").distinct()


class Lookup:
    """The windows of one part, by size: sorted hashes, their words, the items that hold them."""

    def __init__(self, rows: pa.Table):
        self.items = rows["item_id"].combine_chunks()
        size, key = rows["size"].to_numpy(), rows["hash"].to_numpy().view(np.uint64)
        words = rows["words"].to_pylist()
        self.by_size = {}
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            at = at[np.argsort(key[at], kind="stable")]
            hashes, first = np.unique(key[at], return_index=True)
            bits = max(16, int(len(hashes) * 16).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[hashes & np.uint64((1 << bits) - 1)] = True
            self.by_size[int(n)] = (seen, hashes, np.append(first, len(at)), at, [words[k] for k in at])

    def find(self, h, offs, words_of):
        """(word number, size, item rows) of every occurrence in a run of documents."""
        for n, (seen, hashes, first, at, words) in self.by_size.items():
            if len(h) < n:
                continue
            g = _window_hashes(h, n)
            maybe = np.flatnonzero(seen[g & np.uint64(len(seen) - 1)])
            spot = np.minimum(np.searchsorted(hashes, g[maybe]), len(hashes) - 1)
            same = hashes[spot] == g[maybe]
            for s, k in zip(maybe[same], spot[same]):
                if s + n > offs[np.searchsorted(offs, s, "right")]:
                    continue                                    # it runs over a document's end
                got, rows = words_of(s, s + n), range(first[k], first[k + 1])
                hit = [at[r] for r in rows if words[r] == got]
                if hit:
                    yield s, n, hit


def _scan(docs: DataFrame, lookup, id_kind: str, item_kind: str) -> DataFrame:
    def scan(batches):
        table = lookup.value
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            count = np.zeros(len(bounds) - 1, np.int64)
            spans: list[list] = [[] for _ in count]
            items: list[list] = [[] for _ in count]
            for i, j, h, offs, starts, ends in bs.scan_words(buf, bounds, bs.ALNUM, True):
                count[i:j] = np.diff(offs)

                def words_of(a, b, starts=starts, ends=ends):
                    return b" ".join(bytes(bs.LOWER[buf[starts[k]:ends[k]]]) for k in range(a, b))

                for s, n, rows in sorted(table.find(h, offs, words_of), key=lambda x: x[:2]):
                    d = int(np.searchsorted(offs, s, "right")) - 1
                    a = int(s - offs[d])
                    own = spans[i + d]
                    if own and a <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], a + n)
                    else:
                        own.append({"start": a, "end": a + n})
                    items[i + d] += rows
            kept = [sorted({table.items[int(r)].as_py() for r in set(x)}, key=lambda v: (v is None, v))
                    for x in items]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(count),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.list_(table.items.type))],
                ["doc_id", "text_hash", "n_words", "spans", "items"])

    return docs.mapInArrow(scan, SCAN.format(id=id_kind, item=item_kind))


def find_hits(docs: DataFrame, items: DataFrame, n: int = 10, max_windows: int = MAX_WINDOWS
              ) -> DataFrame:
    """doc_id, text_hash, n_words, spans of hit words, items that occur; one row per input row."""
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "decontaminate")
    kinds = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    windows = stages.write(item_windows(items, n))
    parts = max(1, math.ceil(windows.count() / max_windows))
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def part(p: int):
        # by item, too: a window that every item holds is dealt over all parts
        rows = windows.where(F.pmod(F.xxhash64("hash", "item_id"), F.lit(parts)) == p).toArrow()
        return _scan(own, spark.sparkContext.broadcast(Lookup(rows)), *kinds)

    if parts == 1:
        return part(0)
    # the same text gives the same hits: join the parts by text
    hits = part(0).where("size(spans) > 0")
    for p in range(1, parts):
        hits = hits.unionByName(part(p).where("size(spans) > 0"))
    both = hits.dropDuplicates(["doc_id", "text_hash", "spans", "items"]).groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    merge = F.reduce(
        F.col("spans"), F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.get(done, F.size(done) - 1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.get(done, F.size(done) - 1)["start"].alias("start"),
                F.greatest(F.get(done, F.size(done) - 1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(s))))
    merged = both.select("_id", "_hash", merge.alias("spans"), "items")
    empty = Lookup(windows.limit(0).toArrow())
    counted = _scan(own, spark.sparkContext.broadcast(empty), *kinds).select(
        "doc_id", "text_hash", "n_words")
    return counted.join(merged, F.col("doc_id").eqNullSafe(F.col("_id"))
                        & (F.col("text_hash") == F.col("_hash")), "left").select(
        "doc_id", "text_hash", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast(f"array<{kinds[1]}>")).alias("items"))


def remove_spans(texts, spans) -> list[str | None]:
    """Texts without the words of their hit spans; what stood between them goes, too."""
    out = []
    for text, cut in zip(texts, spans):
        if text is None or not len(cut):
            out.append(text)
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        words = [(s, e) for _, _, _, _, ss, ee in bs.scan_words(
            raw, np.array([0, len(raw)]), bs.ALNUM, True) for s, e in zip(ss, ee)]
        keep, at = [], 0
        for c in cut:
            keep.append(bytes(raw[at:words[c["start"]][0]]))
            at = words[c["end"] - 1][1]
        keep.append(bytes(raw[at:]))
        out.append(b"\n".join(keep).decode())
    return out
