"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourlens.llm import bytescan, periodic_runs
from hourlens.llm.queries import with_planted_periods


def runs_of(w, least=6, exponent=4):
    """Every period is tried; a stretch counts with its smallest."""
    out = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i > s and i - s + p >= max(least, exponent * p):
                out.setdefault((s, i - s + p), p)
            i += i == s
    return sorted((s, n, p) for (s, n), p in out.items())


piece = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 11))
texts = st.lists(st.lists(piece, max_size=6).map(lambda ps: [x for w, k in ps for x in w * k]), min_size=1, max_size=4)


@given(texts)
@settings(deadline=None, max_examples=300)
def test_runs_of_many_texts(docs):
    column = pa.array([" " * (i % 2) + "\n".join(f"w{x}" for x in d) + "\t" * (i % 3) for i, d in enumerate(docs)])
    names, words, offs = bytescan.word_numbers(column)
    assert names.take(pa.array(words)).to_pylist() == [f"w{x}" for d in docs for x in d]
    want = [(s + o, n, p) for d, o in zip(docs, offs.tolist()) for s, n, p in runs_of(d)]
    assert periodic_runs.maximal_runs(words, offs) == want


def test_ranks_when_numbers_grow_too_wide():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, 3000)
    offs = np.append(np.sort(rng.integers(0, 3000, 40)), 3000)
    offs[0] = 0
    want = periodic_runs.maximal_runs(words, offs)
    wide = np.concatenate([offs, np.full(2**40 // 3000**2, 3000)])      # many empty texts
    assert want == periodic_runs.maximal_runs(words, wide) and len(want) > 10


def test_long_runs():
    words = np.concatenate([np.tile(np.arange(700), 50), np.zeros(5000, int), np.arange(9000) % 2])
    got = periodic_runs.maximal_runs(words, np.array([0, len(words)]))
    assert (0, 35001, 700) in got and (35000, 5001, 1) in got and (40000, 9000, 2) in got


def brute_row(doc_id, text):
    w = brute.SPACE_WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = sorted(runs_of(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return n, runs, kept


def test_operator_and_planted_periods(spark, docs_of):
    rng = random.Random(2)
    base = ["", " ", None, "one", "a " * 40, "x y " * 9 + "z", "a b c d e f", "\n\ta  b\n" * 30,
            "la la la la la LA la la la la la la", "é ü " * 12 + "é", "x\x1cy " * 8]
    rows = [(i, t) for i, t in enumerate(base)] + [(5, base[5]), (None, base[4]), (None, None)]
    rows += [(100 + i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(200)))) for i in range(60)]
    rows += [(200, "long " + " ".join(f"v{i % 4001}" for i in range(190_000)))]    # above a piece
    assert len(rows[-1][1]) > bytescan.PIECE
    rows += [(d, "a b c a b d e") for d in range(10**6, 10**6 + 40)]
    docs = docs_of(rows, extra=True)
    got = periodic_runs.find_runs(with_planted_periods(docs)).orderBy("doc_id").collect()
    want = sorted(((d, *brute_row(d, t)) for d, t in rows if d != 200), key=str)
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["kept"])
                   for r in got if r["doc_id"] != 200), key=str) == want
    assert any(r[2] for r in want)
    long = next(r for r in got if r["doc_id"] == 200)
    assert [tuple(x) for x in long["runs"]] == [(1, 190_000, 4001)]
    assert long["kept"] == "long " + " ".join(f"v{i}" for i in range(4001))
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    text_ids = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert periodic_runs.find_runs(text_ids).where("doc_id = '4'").first()["runs"][0]["length"] == 40


def test_query_digests(spark, docs_of, tmp_path):
    from hourlens.llm.registry import QUERIES

    rows = [(i, "a b c " * (i % 7) + "d e") for i in range(80)] + [(None, "q " * 9)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect():
        n, runs, kept = brute_row(r["doc_id"], dict(rows)[r["doc_id"]])
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        milli = 1000 * top[1] // top[2] if runs else None
        digest = hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in runs).encode()).hexdigest()
        assert tuple(r) == (r["doc_id"], len(runs), *top, milli, digest, hashlib.sha256(kept.encode()).hexdigest())
