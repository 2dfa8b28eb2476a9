"""Nearest neighbours by inner product: multi-index hashing over learned rotated binary codes.

1. Copies of a vector are one entry of the index that keeps the few smallest ids it can be asked for.
2. Codes: the signs of rotated vectors.  Rotations start from the principal axes of a sample of at most ``SAMPLE``
   vectors and are turned, one after the other, until signs lose least (iterative quantisation).  All vectors are encoded.
3. Index: blocks of about ``BLOCK`` entries in order of length; a code is cut into substrings, and each block keeps
   for every substring the places of its entries in order of that substring's value.
4. Probing: two codes within Hamming distance r agree within r // m on one of the first r % m + 1 of m substrings
   or within r // m - 1 on one of the others (pigeonhole), so probing these substring values finds every
   entry within r.  Entries found are held to r by their whole codes, the rest is reranked by the vectors themselves.
5. Radius: two rounds.  The first takes the distance within which the sample says some ``FIRST`` entries lie, and
   gives every query a score that its last neighbour reaches or exceeds.  A neighbour of that score lies at a
   known angle at most, and codes of vectors at an angle t differ in a share t / pi of their bits; the second
   round's radius is that share and ``MARGIN`` standard deviations more.  A block whose longest vector cannot reach
   the score is left out.  A query that found too few entries searches with no limit.
   The more entries there are, the smaller both radii become.

Queries meet blocks in cells of ``GROUP`` queries by one block; a cell returns at most k + 1 entries per query.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors of another
length than most have; of rows that share an id the smallest vector counts, rows without an id take no part; ties go to the
smaller id; with fewer candidates than asked for all are returned; an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlens.llm.common import Stages, hash_pair, small_batches

SAMPLE = 8192           # vectors the rotations are learned from
BITS = 128              # eight substrings of 16 bits
BLOCK, GROUP = 32768, 1024
FIRST = 80              # entries the first round wants to find
MARGIN = 1.6            # standard deviations of code distance added in the second round
TURNS = 30              # steps of the rotation's fit


def clean_vectors(rows: DataFrame, id_column: str, column: str) -> DataFrame:
    """id and v (array of double): the rows that take part."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.select(F.col(id_column).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count()
    usual = lengths.orderBy(F.desc("count"), "n").limit(1).select("n")
    rows = rows.join(F.broadcast(usual), F.size("v") == F.col("n")).drop("n")       # one row
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def entries(vectors: DataFrame, most: int) -> DataFrame:
    """v, norm and ids: distinct vectors with their ``most`` smallest ids."""
    first = Window.partitionBy("v").orderBy("id")
    few = vectors.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("norm", norm)


def learn_rotations(sample: np.ndarray, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """A matrix of ``bits`` columns: principal axes, rotated so that signs lose least of the sample."""
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    rng, out, left = np.random.default_rng(seed), [], bits
    _, axes = np.linalg.eigh(sample.T @ sample)
    while left > 0:
        width = min(left, sample.shape[1])
        base = axes[:, ::-1][:, :width]
        flat = sample @ base
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(TURNS):
            u, _, w = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (u @ w).T
        out.append(base @ turn)
        left -= width
    return np.concatenate(out, axis=1)


def encode(vectors: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes; padded with zero bits to whole 64-bit words."""
    bits = np.packbits(vectors @ rotations >= 0, axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes.view(np.uint64) ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)


class MultiIndex:
    """One block's codes, cut into substrings of 16 bits; every substring has its own table."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        parts = codes.view(np.uint16)
        self.tables = []
        for j in range(parts.shape[1]):
            order = np.argsort(parts[:, j], kind="stable")
            values, begin = np.unique(parts[order, j], return_index=True)
            self.tables.append((values, begin, np.append(begin[1:], len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes within Hamming distance ``radius``."""
        if radius < 0:
            return np.empty(0, np.int64)
        base, over = divmod(radius, len(self.tables))
        marked = np.zeros(len(self.codes), bool)
        for j, (key, (values, begin, end, order)) in enumerate(zip(code.view(np.uint16), self.tables)):
            reach = base if j <= over else base - 1
            if reach < 0:
                continue
            # the substring values in use stand in for the ball around the key once they are fewer
            probe = np.bitwise_count(values ^ key) <= reach
            if probe.all():
                marked[:] = True
                break
            n = (end - begin)[probe]
            spots = np.repeat(begin[probe] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            marked[order[spots]] = True
        found = np.flatnonzero(marked)
        return found[distances(self.codes[found], code) <= radius]


def radius_for(score: float, norm: float, lengths: tuple[float, float], bits: int, margin: float) -> int:
    """Code distance within which a vector of this score lies, if it has one of these lengths; -1: there is none."""
    if score == -math.inf:
        return bits
    cosine = score / (norm * (lengths[1] if score > 0 else lengths[0]))
    if cosine > 1 + 1e-9:
        return -1
    share = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return min(bits, math.floor(bits * share + margin * math.sqrt(bits * share * (1 - share)) + 0.5))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _cells(index: DataFrame, queries: DataFrame, blocks: int, groups: int, rotations, most: int, margin: float,
           radius: int | None) -> DataFrame:
    """query, score, ids: in every block, the best entries within the radius of each query.

    ``radius`` None: by the score each query is known to reach."""
    bits = rotations.value.shape[1]

    def search(_, own: pa.Table, asked: pa.Table) -> pa.Table:
        vectors = _matrix(own["v"]) if len(own) else None
        at, rows, scores = [], [], []
        if len(own) and len(asked):
            codes = np.frombuffer(b"".join(own["code"].to_pylist()), np.uint8).reshape(len(own), -1)
            index, size = MultiIndex(codes), own["norm"].to_numpy()
            lengths = float(size.min()), float(size.max())
            wanted = _matrix(asked["v"])
            keys = encode(wanted, rotations.value)
            norms, reached = asked["norm"].to_numpy(), asked["reached"].to_numpy()
            for i, (vector, key) in enumerate(zip(wanted, keys)):
                r = radius if radius is not None else radius_for(reached[i], norms[i], lengths, bits, margin)
                found = index.within(key, r)
                score = np.einsum("ij,j->i", vectors[found], vector)
                if len(found) > most:           # ties at the end stay: ids decide later
                    edge = np.partition(score, len(score) - most)[len(score) - most]
                    keep = np.flatnonzero(score >= edge)
                    found, score = found[keep], score[keep]
                at.append(np.full(len(found), i))
                rows.append(found)
                scores.append(score)
        rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
        return pa.table({
            "query": asked["query"].combine_chunks().take(pa.array(np.concatenate(at) if at else rows)),
            "score": pa.array(np.concatenate(scores) if scores else rows, pa.float64()),
            "ids": own["ids"].combine_chunks().take(pa.array(rows)) if len(own) else pa.array([], own["ids"].type)})

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kind = dict(index.dtypes)["ids"]
    left = index.withColumn("group", every(groups)).groupBy("block", "group")
    right = queries.withColumn("block", every(blocks)).groupBy("block", "group")
    return left.cogroup(right).applyInArrow(search, f"query string, score double, ids {kind}")


def search(rows: DataFrame, asked: Column, k: int = 20, id_column: str = "vec_id", column: str = "embedding",
           sample: int = SAMPLE, block: int = BLOCK, margin: float = MARGIN) -> DataFrame:
    """query_id, rank (from 1), id and score: the ``k`` nearest others of every row whose id is ``asked`` for
    (a condition on the column ``id``)."""
    spark = rows.sparkSession
    small_batches(spark)
    stages = Stages(spark, "vectors")
    vectors = stages.write(clean_vectors(rows, id_column, column))
    held = stages.write(entries(vectors, k + 1))
    known = _matrix_of(held.orderBy(F.xxhash64("v"), "v").limit(sample).select("v"))     # at most ``sample`` rows
    kind = dict(vectors.dtypes)["id"]
    if not len(known):
        return spark.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score double")
    learned = learn_rotations(known)
    rotations = spark.sparkContext.broadcast(learned)

    def coded(batches):
        for batch in batches:
            codes = encode(_matrix(pa.chunked_array([batch["v"]])), rotations.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())], [*batch.schema.names, "code"])

    total = held.count()
    blocks = math.ceil(total / block)
    laid = held.repartitionByRange(blocks, "norm", F.xxhash64("v")).withColumn(
        "block", F.spark_partition_id() % blocks).select("v", "norm", "ids", "block")
    index = stages.write(laid.mapInArrow(coded, f"v array<double>, norm double, ids array<{kind}>, block int, code binary"))

    # distinct query vectors, dealt into groups
    wanted = vectors.where(asked).groupBy("v").agg(F.count("*").alias("alike"))
    groups = max(1, math.ceil(wanted.count() / GROUP))
    queries = stages.write(wanted.join(held.select("v", "norm"), "v").select(
        _name(F.col("v")).alias("query"), "v", "norm", F.pmod(F.xxhash64("v", F.lit(1)), F.lit(groups)).cast("int").alias("group")))

    own = encode(known[:256], learned)
    near = np.sort(np.concatenate([distances(encode(known, learned), c) for c in own]))
    first = int(near[min(len(near) - 1, int(len(near) * FIRST / total))]) if total > FIRST else BITS
    most = k + 1
    blank = queries.withColumn("reached", F.lit(-math.inf))
    begun = _cells(index, blank, blocks, groups, rotations, most, margin, first)
    by_query = Window.partitionBy("query").orderBy(F.desc("score"))
    reached = begun.select("query", "score").withColumn("n", F.row_number().over(by_query)).where(
        F.col("n") <= most).groupBy("query").agg(
        F.when(F.count("*") == most, F.min("score")).otherwise(F.lit(-math.inf)).alias("reached"))
    ready = stages.write(queries.join(reached, "query", "left").fillna(-math.inf, ["reached"]))
    found = stages.write(_cells(index, ready, blocks, groups, rotations, most, margin, None))
    rotations.unpersist()

    # copies share a search: each of their rows gets its own list without itself
    near = found.withColumn("id", F.explode("ids")).select("query", "score", "id")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    near = near.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= most).drop("n")
    askers = vectors.where(asked).select(F.col("id").alias("query_id"), _name(F.col("v")).alias("query"))
    pairs = askers.join(near, "query").where("query_id <> id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")


def _name(v: Column) -> Column:
    """128 bits that stand for a vector."""
    return F.concat_ws("-", *[F.hex(h) for h in hash_pair(v)])


def _matrix_of(df: DataFrame) -> np.ndarray:
    rows = df.collect()
    return np.array([r[0] for r in rows], np.float64) if rows else np.empty((0, 0))
