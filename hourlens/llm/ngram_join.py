"""N-gram Jaccard join: exact links between documents whose shingle sets overlap by a ratio.

1. Equal sets are folded into one by a 128-bit digest of the set.
2. A set of n shingles can only reach the ratio with a set that shares one of its first
   n - ceil(ratio * n) + 1 shingles, in any order both agree on.  The order is from rare to frequent
   by a counting sketch over the whole corpus, then by hash.  Sets that share such a
   shingle and whose sizes are within the ratio meet in a tile: (shingle, size band).
   Shingles with the same members make one tile, that of the first of them.
   Sets that link share no more than what each has from their first common shingle on, so the
   place of a shingle in a set limits the partners' sizes in its tile (reach).  A set whose reach is below
   the sizes of all that could be its smaller partner leaves the tile: template pages that differ
   too much to link never meet.
3. Each set carries a bitmap of one parity bit per hash slot, as wide as its size asks for.  The
   bits in which two bitmaps differ are a lower bound of the shingles in which the sets differ, hence
   an upper bound of their overlap; pairs beyond it are dropped, the rest is decided by
   intersecting the sorted arrays.
4. Links inside a group of copies are not all listed.  First every set of a tile meets its pivots,
   the smallest member of its band and the band below.  What that joins is one component; later rounds
   list pairs only across components, a few per set and component first, then, where that left some
   out, all that are still apart.
   Every pair of a tile ends up in one component or decided by intersection, so components are exact.

Large tiles are cut into blocks twice: all sets into home blocks, those outside the tile's main component
also into guest blocks.  A task takes one home and one guest block, so none holds a whole group.

Defined results: a null or empty text, or one of white space, has an empty set, links with nothing and is its own
component; fewer words than the shingle size make one shingle of all; a null doc_id links with nothing and
has a null component; repeated rows each get a row; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlens.llm import bytescan as bs
from hourlens.llm.common import Stages, small_batches
from hourlens.llm.components import components

SKETCH_BITS = 22        # counters of the sketch; more of them tell rarer shingles apart
BLOCK = 4096            # sets of a tile's home block, and of its guest block, that one task compares
ROUNDS = 4              # parts in which prefix shingles are looked through
QUOTA = 3               # pairs listed per set and foreign component before all are
PAIRS = 1 << 20         # pairs looked at in one step of a task
_A = np.uint64(0xA0761D6478BD642F)


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Distinct shingle hashes of one document, ascending."""
    if len(h) == 0:
        return h
    size = min(n, len(h))
    return np.unique(bs.mix(bs.window_sums(h, size) * _A + np.uint64(size)))


def _sets(batch, n: int):
    buf, bounds = bs.buffers(batch["text"])
    for i, j, h, offs, _, _ in bs.scan_words(buf, bounds, bs.NOT_SPACE, True):
        for d in range(j - i):
            yield i + d, shingle_hashes(h[offs[d]:offs[d + 1]], n)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, n: int, stages: Stages, bits: int = SKETCH_BITS) -> np.ndarray:
    """How often each hash slot's shingles occur over all documents.  Fixed size."""
    part = 1 << 14

    def count(batches):
        total = np.zeros(1 << bits, np.int32)
        for batch in batches:
            for _, _, h, offs, _, _ in bs.scan_words(*bs.buffers(batch["text"]), bs.NOT_SPACE, True):
                s = bs.mix(bs.window_sums(h, n) * _A + np.uint64(n))[bs.whole_windows(offs, n)]
                np.add.at(total, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
        rows = total.reshape(-1, part)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([rows[k].tobytes() for k in used], pa.binary())],
            ["part", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch["part"].to_pylist(), batch["counts"].to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(c, np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(
                [np.minimum(c, 2**31 - 1).astype(np.int32).tobytes() for c in sums.values()], pa.binary())],
            ["part", "counts"])

    kind = "part int, counts binary"
    out = np.zeros(((1 << bits) // part, part), np.int32)
    summed = stages.write(docs.select("text").mapInArrow(count, kind).repartition("part").mapInArrow(add, kind))
    for row in summed.collect():                                # 2^bits counters in all
        out[row["part"]] = np.frombuffer(row["counts"], np.int32)
    stages.drop(summed)
    return out.reshape(-1)


def parity_bitmap(s: np.ndarray) -> bytes:
    """A bit per slot: is the number of shingles in it odd?  Slots: a power of two, by set size."""
    slots = 1 << min(12, max(6, int(len(s)).bit_length()))
    odd = np.bincount((s & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of bitmaps (uint64 words); the wider is folded, which keeps parities."""
    while a.shape[1] > b.shape[1]:
        a = a[:, :a.shape[1] // 2] ^ a[:, a.shape[1] // 2:]
    while b.shape[1] > a.shape[1]:
        b = b[:, :b.shape[1] // 2] ^ b[:, b.shape[1] // 2:]
    return np.bitwise_count(a ^ b).sum(axis=1)


def within(differing, total, ratio) -> np.ndarray:
    """Could sets of ``total`` shingles together that differ in this many reach the ratio?

    With i shared and u in the union, total = i + u and differing = u - i."""
    p, q = ratio
    return q * (total - differing) >= p * (total + differing)


def _columns(batch, *names):
    return [batch[n].to_numpy(zero_copy_only=False) for n in names]


def signatures(docs: DataFrame, n: int, ratio, heat) -> DataFrame:
    """doc_id, sid (digest of the set), size, bitmap, prefix (first shingles of the common order)."""
    p, q = ratio

    def sign(batches):
        hot = heat.value
        bits = np.uint64(64 - int(len(hot)).bit_length() + 1)
        for batch in batches:
            sid, size, bitmap, flat, offs = [], [], [], [], [0]
            for _, s in _sets(batch, n):
                k = len(s) - (p * len(s) + q - 1) // q + 1 if len(s) else 0
                order = np.argsort(hot[(s >> bits).astype(np.int64)], kind="stable")[:k]
                sid.append(_digest(s))
                size.append(len(s))
                bitmap.append(parity_bitmap(s))
                flat.append(s[order])
                offs.append(offs[-1] + k)
            values = np.concatenate(flat).view(np.int64) if flat else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sid, pa.binary()), pa.array(size, pa.int64()),
                 pa.array(bitmap, pa.binary()), bs.listed(np.array(offs), values, pa.int64())],
                ["doc_id", "sid", "size", "bitmap", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {kind}, sid binary, size long, bitmap binary, prefix array<long>")


def decide(pairs: DataFrame, docs: DataFrame, sets: DataFrame, n: int, ratio, stages: Stages) -> DataFrame:
    """The pairs (a, b) that are links, by intersecting the sorted sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    where = sets.join(wanted, "sid", "left_semi").select(F.col("owner").alias("_owner")).distinct()
    texts = docs.select("doc_id", "text").join(
        where.hint("shuffle_hash"), F.col("doc_id") == F.col("_owner"), "left_semi")

    def build(batches):
        for batch in batches:
            found = [s for _, s in _sets(batch, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in found], pa.binary()),
                 pa.array([s.tobytes() for s in found], pa.binary())], ["sid", "shingles"])

    full = stages.write(texts.mapInArrow(build, "sid binary, shingles binary"))
    first, second = (full.select(F.col("sid").alias(f"_{s}"), F.col("shingles").alias(f"s{s}")) for s in "ab")
    laid = pairs.join(first, F.col("a") == F.col("_a")).join(second, F.col("b") == F.col("_b"))
    p, q = ratio

    def intersect(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["sa"], batch["sb"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                spot = np.minimum(np.searchsorted(x, y), len(x) - 1)
                shared = int((x[spot] == y).sum())
                keep.append(q * shared >= p * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = stages.write(laid.select("a", "b", "sa", "sb").mapInArrow(
        intersect, "a binary, b binary").distinct())
    stages.drop(full)
    return links


def _bounded(pairs: DataFrame, ratio) -> DataFrame:
    """Pairs (a, b, na, nb, ba, bb) that the bitmaps do not rule out."""
    def screen(batches):
        for batch in batches:
            na, nb = _columns(batch, "na", "nb")
            ba, bb = batch["ba"].to_pylist(), batch["bb"].to_pylist()
            width = np.array([len(x) for x in ba]) * 4096 + np.array([len(x) for x in bb])
            ok = np.zeros(len(na), bool)
            for w in np.unique(width) if len(na) else ():
                at = np.flatnonzero(width == w)
                x, y = (np.frombuffer(b"".join(side[k] for k in at), np.uint64).reshape(len(at), -1)
                        for side in (ba, bb))
                ok[at] = within(differing_bits(x, y).astype(np.int64), na[at] + nb[at], ratio)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(screen, "a binary, b binary")


def _across(rows: DataFrame, ratio, quota: int | None) -> DataFrame:
    """Candidate pairs (a, b) across components inside each block of each tile; ``cut`` where the
    quota left others out."""
    def compare(batches):
        held, count, last = [], 0, None
        for batch in batches:
            tile = batch["tile"].to_numpy()
            cuts = np.flatnonzero(np.diff(tile)) + 1
            # whole tiles only: what is before the last one's start may go
            edge = int(cuts[-1]) if len(cuts) else 0
            if len(tile) and held and tile[0] != last and edge == 0:
                edge = -1
            if count + len(tile) > BLOCK and edge:
                if edge > 0:
                    held.append(batch.slice(0, edge))
                yield _pairs(held, ratio, quota)
                batch = batch.slice(max(edge, 0))
                held, count = [], 0
            held.append(batch)
            count += len(batch)
            last = tile[-1] if len(tile) else last
        if held:
            yield _pairs(held, ratio, quota)

    laid = rows.withColumn("tile", F.xxhash64("token", "to_band", "block")).select(
        "tile", "sid", "size", "reach", "comp", "bitmap", "home", "free")
    return laid.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        compare, "a binary, b binary, cut boolean").groupBy("a", "b").agg(F.max("cut").alias("cut"))


def _pairs(held: list[pa.RecordBatch], ratio, quota) -> pa.RecordBatch:
    """Free rows against the home rows of their tile, over several tiles at once."""
    rows = pa.Table.from_batches(held)
    tile, size, reach, home, free = (rows[c].to_numpy() for c in ("tile", "size", "reach", "home", "free"))
    comp = rows["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
    sid, bitmaps = rows["sid"].to_pylist(), rows["bitmap"].to_pylist()
    width = np.array([len(x) // 8 for x in bitmaps])
    words, at = np.frombuffer(b"".join(bitmaps), np.uint64), np.cumsum(width) - width
    p, q = ratio
    homes, guests = np.flatnonzero(home), np.flatnonzero(free)
    homes, guests = homes[np.argsort(tile[homes], kind="stable")], guests[np.argsort(tile[guests])]
    low, high = (np.searchsorted(tile[homes], tile[guests], side) for side in ("left", "right"))
    found = []
    for part in np.array_split(np.arange(len(guests)), max(1, int((high - low).sum()) // PAIRS)):
        n = high[part] - low[part]
        x = np.repeat(guests[part], n)
        y = homes[np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ok = (comp[x] != comp[y]) & (q * np.minimum(size[x], size[y]) >= p * np.maximum(size[x], size[y]))
        ok &= (size[x] <= reach[y]) & (size[y] <= reach[x])
        x, y = x[ok], y[ok]
        far = np.empty(len(x), np.int64)
        kinds = width[x] * 4096 + width[y]
        for kind in np.unique(kinds):
            k = np.flatnonzero(kinds == kind)
            a, b = (words[at[z[k], None] + np.arange(width[z[k[0]]])] for z in (x, y))
            far[k] = differing_bits(a, b)
        ok = within(far, size[x] + size[y], ratio)
        found.append((x[ok], y[ok], far[ok]))
    x, y, far = (np.concatenate(v) for v in zip(*found))
    order = np.lexsort((far, comp[y], x))
    x, y = x[order], y[order]
    new = np.append(True, (x[1:] != x[:-1]) | (comp[y][1:] != comp[y][:-1]))[:len(x)]
    begin = np.flatnonzero(new)
    many = np.diff(np.append(begin, len(x)))
    rank = np.arange(len(x)) - np.repeat(begin, many)
    keep = np.ones(len(x), bool) if quota is None else rank < quota
    cut = np.zeros(len(x), bool) if quota is None else np.repeat(many > quota, many)
    a, b = zip(*(sorted((sid[i], sid[j])) for i, j in zip(x[keep], y[keep]))) if keep.any() else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(cut[keep])], ["a", "b", "cut"])


def _dealt(mixed: DataFrame) -> DataFrame:
    """Home rows in one block of their band and free rows, as guests, in one guest block of each
    band around theirs; a row for every pair of blocks (``block``) it belongs to."""
    def blocks(rows, name):
        return rows.groupBy("token", "to_band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    homes = mixed.withColumn("to_band", F.col("band"))
    guests = mixed.where("free").withColumn("to_band", F.explode(F.array(
        F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    cuts = blocks(homes, "hb").join(blocks(guests, "gb"), ["token", "to_band"])
    own = lambda n, seed: F.pmod(F.xxhash64("sid", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    homes = homes.join(cuts, ["token", "to_band"]).withColumn("h", own("hb", 0)).withColumn("g", every("gb"))
    guests = guests.join(cuts, ["token", "to_band"]).withColumn("g", own("gb", 1)).withColumn("h", every("hb"))
    homes = homes.withColumn("home", F.lit(True)).withColumn("free", F.lit(False))
    return homes.unionByName(guests.withColumn("home", F.lit(False))).withColumn(
        "block", F.col("h").cast("long") * F.col("gb") + F.col("g")).drop("h", "g", "hb", "gb")


def shared_tokens(sets: DataFrame, ratio, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Prefix shingles of two sets or more: what their members have in common, and their entries
    (token, sid, size, place, reach).

    Most shingles of a prefix are nobody else's.  They are dealt into ``ROUNDS`` by hash, and what a round
    shuffles to find the others is gone before the next, so no more than a part of all prefixes is on disk at once."""
    # reach: the largest set with which it can share enough if the token is the first they share
    laid = sets.select("sid", "size", F.posexplode("prefix").alias("place", "token")).withColumn(
        "reach", F.expr(f"(size - place) * {sum(ratio)} div {ratio[0]} - size"))
    members, entries = [], []
    for k in range(ROUNDS):
        own = laid.where(F.pmod("token", F.lit(ROUNDS)) == k)
        found = own.groupBy("token").agg(
            F.count("*").alias("m"), F.sum(F.shiftright(F.xxhash64("sid"), 32)).alias("m1"),
            F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("m2"),
            F.min("size").alias("least"), F.max("size").alias("most"), F.min("place").alias("place"),
            F.min(F.when(F.col("reach") >= F.col("size"), F.col("size"))).alias("short")).where("m > 1")
        # two sets whose sizes are too far apart make no tile
        members.append(stages.write(found.where(
            (F.col("m") > 2) | (F.col("least") * ratio[1] >= F.col("most") * ratio[0]))))
        entries.append(stages.write(own.join(members[-1].select("token"), "token", "left_semi")))
    out = reduce(DataFrame.unionByName, members), reduce(DataFrame.unionByName, entries)
    for table, parts in zip(out, (members, entries)):
        table._parts = parts
    return out


def link_components(docs: DataFrame, n: int = 3, ratio: tuple[int, int] = (90, 100),
                    sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id a chain of links reaches."""
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "ngram-join")
    heat = spark.sparkContext.broadcast(sketch(docs, n, stages, sketch_bits))
    full = stages.write(signatures(docs, n, ratio, heat))
    heat.unpersist()
    wide = stages.write(full.where("size > 0 and doc_id is not null").groupBy("sid").agg(
        F.min("doc_id").alias("owner"), F.first("size").alias("size"),
        F.first("bitmap").alias("bitmap"), F.first("prefix").alias("prefix")))
    signed = stages.write(full.select("doc_id", "sid", "size"))
    stages.drop(full)

    # tiles: shingles of two sets or more, once for each distinct list of members
    members, entries = shared_tokens(wide, ratio, stages)
    sets = stages.write(wide.drop("prefix"))
    stages.drop(wide)
    # the first shingle of equal members: what pairs share before it would have the same members
    first = F.min(F.struct("place", "token", "short"))
    tiles = members.groupBy("m", "m1", "m2").agg(first.alias("t")).select("m", "t.token", "t.short")
    # a little wider than the ratio, so rounding never puts a fitting pair two bands apart
    band = F.floor(F.log("size") / (1.0001 * math.log(ratio[1] / ratio[0]))).cast("int")
    # of a pair the smaller set reaches its own size; without one in reach a set has no partner here
    rows = stages.write(entries.join(tiles, "token").where(F.col("reach") >= F.col("short")).select(
        "token", "sid", "size", "reach", "m", band.alias("band")))
    stages.drop(*entries._parts, *members._parts)

    # pivots: every set against the smallest member of its own band and of the one below
    pivots = rows.groupBy("token", "band").agg(F.min("sid").alias("pivot"))
    near = rows.select("token", "sid", "band")
    below = rows.select("token", "sid", (F.col("band") - 1).alias("band"))
    pairs = near.join(pivots, ["token", "band"]).unionByName(
        below.join(pivots, ["token", "band"])).where("sid <> pivot").select(
        F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")).distinct()
    about = sets.select("sid", "size", "bitmap")
    first, second = (about.toDF(f"_{s}", f"n{s}", f"b{s}") for s in "ab")
    fit = F.least("na", "nb") * ratio[1] >= F.greatest("na", "nb") * ratio[0]
    pairs = stages.write(_bounded(
        pairs.join(first, F.col("a") == F.col("_a")).join(second, F.col("b") == F.col("_b"))
        .where(fit).select("a", "b", "na", "nb", "ba", "bb"), ratio))
    links = decide(pairs, docs, sets, n, ratio, stages)
    tried = pairs
    roots = components(links, stages)

    for quota in (QUOTA, None):
        named = rows.where("m > 2").join(
            roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
            "comp", F.coalesce("root", "sid")).drop("root")
        per = named.groupBy("token", "comp").agg(F.count("*").alias("k"))
        main = per.groupBy("token").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"),
                                        F.count("*").alias("kinds")).where("kinds > 1")
        mixed = named.join(main, "token").withColumn("free", F.col("comp") != F.col("main"))
        laid = _dealt(mixed).join(about.select("sid", "bitmap"), "sid")
        pairs = stages.write(_across(laid, ratio, quota))
        whole = pairs.where("cut").isEmpty()
        pairs = stages.write(pairs.select("a", "b").join(tried, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            tried = stages.write(tried.unionByName(pairs))
            links = stages.write(links.unionByName(decide(pairs, docs, sets, n, ratio, stages)))
            roots = components(links, stages)
        if whole:                            # no pair was left out
            break

    owners = sets.select("sid", "owner").join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "owner", F.coalesce("root", "sid").alias("root"))
    lowest = owners.groupBy("root").agg(F.min("owner").alias("component_id"))
    placed = owners.join(lowest, "root").select("sid", "component_id")
    return stages.result(signed.join(placed, "sid", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
        .alias("component_id")))
