"""Multi-index hashing against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourlens.llm import queries, vector_search  # noqa: F401
from hourlens.llm.registry import QUERIES

KIND = "vec_id long, embedding array<float>"


def brute(rows, k, asked):
    """{query: [(score, id)]} for rows of (id, vector)."""
    fine = {}
    lengths = [len(v) for i, v in rows if i is not None and good(v)]
    usual = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    for i, v in rows:
        if i is not None and good(v) and len(v) == usual:
            fine[i] = min(fine.get(i, v), v)
    ids = sorted(fine)
    m = np.array([fine[i] for i in ids], np.float32).astype(float).reshape(len(ids), usual)
    out = {}
    for at, i in enumerate(ids):
        if asked(i):
            s = np.array([float(np.dot(x, m[at])) for x in m])
            order = [j for j in sorted(range(len(ids)), key=lambda j: (-s[j], ids[j])) if j != at][:k]
            out[i] = [(s[j], ids[j]) for j in order]
    return out


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["id"]))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items() if [x[0] for x in sorted(v)] == list(range(1, len(v) + 1))}


def recall(got, want):
    return sum(len({i for _, i in got[q]} & {i for _, i in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_probing_finds_all_within():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 16), np.uint8)
    codes[200:] = codes[rng.integers(0, 20, 300)] ^ (rng.random((300, 16)) < 0.1).astype(np.uint8)
    index = vector_search.MultiIndex(codes)
    for r in (-1, 0, 1, 3, 7, 8, 9, 20, 47, 60, 128):
        for code in codes[::37]:
            far = [int(np.unpackbits(code ^ c).sum()) for c in codes]
            assert index.within(code, r).tolist() == [i for i, d in enumerate(far) if d <= r]


def test_codes_follow_angles():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 24))
    r = vector_search.learn_rotations(x)
    assert r.shape == (24, 128)
    codes = vector_search.encode(x, r)
    cosine = x @ x[0] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[0])
    share = vector_search.distances(codes, codes[0]) / 128
    assert np.corrcoef(share, np.arccos(np.clip(cosine, -1, 1)) / np.pi)[0, 1] > 0.8


def hard_rows():
    rng = np.random.default_rng(3)
    v = lambda: rng.integers(-3, 4, 6).astype(float).tolist()
    rows = [(i, v()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]          # copies, more than are asked for
    rows += [(200, None), (201, [0.0] * 6), (202, [1.0, None] + [0.0] * 4), (203, [math.nan] * 6), (204, [math.inf] * 6),
             (205, [1.0, 2.0]), (206, []), (None, rows[5][1]), (7, rows[7][1]), (8, [9.0] * 6), (220, [-x for x in rows[3][1]])]
    return rows


def test_small_tables_are_exact(spark):
    rows = hard_rows()
    df = spark.createDataFrame(rows, KIND)
    for c in ("v", "norm", "ids", "n", "code", "block", "group", "query", "score", "rank", "id"):
        df = df.withColumn(c, F.lit("x"))
    got = lists(vector_search.search(df, F.col("id") % 5 == 0, 20))
    assert got == brute(rows, 20, lambda i: i % 5 == 0)
    few = [r for r in rows[:9]]
    got = lists(vector_search.search(spark.createDataFrame(few, KIND), F.lit(True), 20))
    assert got == brute(few, 20, lambda i: True) and {len(v) for v in got.values()} == {8}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(20, [1.0, 2.0])], [(None, [1.0])]])
def test_nothing_to_find(spark, rows):
    out = vector_search.search(spark.createDataFrame(rows, KIND), F.col("id") % 20 == 0)
    assert out.columns == ["query_id", "rank", "id", "score"] and out.count() == 0


def test_recall_over_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 32))
    x = centres[rng.integers(0, 30, 3000)] + 0.7 * rng.standard_normal((3000, 32))
    x[:1500] = rng.standard_normal((1500, 32))
    x *= rng.lognormal(0, 0.5, (3000, 1))                       # lengths differ
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32).astype(float))]
    monkeypatch.setattr(vector_search, "GROUP", 40)
    df = spark.createDataFrame(rows, KIND)
    got = lists(vector_search.search(df, F.col("id") % 20 == 0, sample=500, block=400))
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) > 0.95
    score = {(q, i): s for q, w in brute(rows, 3000, lambda i: i % 20 == 0).items() for s, i in w}
    assert all(abs(s - score[q, i]) < 1e-9 for q, v in got.items() for s, i in v)
    assert lists(vector_search.search(df, F.col("id") % 20 == 0, sample=500, block=400)) == got


def test_query_recall(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    out = QUERIES["op12_nearest_vectors"](spark, sf_dir)
    assert dict(out.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    got, want = lists(out.withColumnRenamed("vec_id", "id")), brute(rows, 20, lambda i: i % 20 == 0)
    assert set(got) == set(want) and recall(got, want) >= 0.95
