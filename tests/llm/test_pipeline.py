"""The pipeline's stages against plain Python, each on its own input, and the whole run."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from test_text_ops import edited, hits, measures, words
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from hourlens.llm.queries import tokenizer_json

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    menu = "Share this page " + words(rng, 55, 10**6)
    passage = words(rng, 30, 10**6)
    rows = [(i, words(rng, 120, 10**6) + ("\n" + menu if i % 3 == 0 else ""), f"s{i % 2}") for i in range(80)]
    rows += [(100 + i, edited(rng, rows[1][1], 0.01), "s0") for i in range(6)]
    rows += [(110, rows[2][1], "s1"), (111, rows[2][1], None), (112, words(rng, 60, 10**6) + " " + passage, None),
             (113, passage.upper() + " " + words(rng, 60, 10**6), "s0"), (114, None, "s1"), (115, "", "s1"),
             (116, "too short", "s0"), (117, "again and again " * 40, "s0"), (None, words(rng, 70, 10**6), "s0"),
             (118, menu + "\n" + words(rng, 12, 10**6), "s0"), (3, rows[3][1], "s1"), (3, rows[3][1], "s1")]
    return [(d, t, "en", s, len(t or "")) for d, t, s in rows], [(1, passage), (2, None)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs, items = corpus()
    spark.createDataFrame(docs, FIELDS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def boilerplate(rows):
    """Normalised lines above the limit, by source."""
    texts, held = defaultdict(set), defaultdict(set)
    for _, text, _, source, _ in rows:
        texts[source].add(text)
        for line in (text or "").split("\n"):
            if brute.SPACE_WORD.search(line):
                held[source, line.strip(" \t\n\x0b\x0c\r").translate(brute.AZ)].add(text)
    return {k for k, v in held.items() if len(v) > 8 and len(v) > 0.05 * len(texts[k[0]])}


def quality(rows):
    bad, out = boilerplate(rows), []
    for d, text, lang, source, n in rows:
        count, _, _, _, repeated = measures(text)
        lines = (text or "").split("\n")
        gone = [(source, x.strip(" \t\n\x0b\x0c\r").translate(brute.AZ)) in bad for x in lines]
        lost = sum(len(brute.SPACE_WORD.findall(x)) for x, g in zip(lines, gone) if g)
        if count >= 50 and 100 * repeated <= 50 * count and 100 * lost <= 50 * count:
            left = "\n".join(x for x, g in zip(lines, gone) if not g)
            out.append((d, left, lang, source, len(left)))
    return out


def test_stages(spark, sf_dir, monkeypatch):
    from hourlens.llm import quality_rules

    monkeypatch.setattr(quality_rules.judge, "__defaults__", (0.05, 8, 50, 1000, False))
    docs, rows = spark.read.parquet(f"{sf_dir}/documents.parquet"), corpus()[0]
    done = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{sf_dir}/{name.replace(' ', '-')}"
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns == corpus_pipeline.COLUMNS
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        done[name] = [tuple(r) for r in docs.collect()]

    assert Counter(done["quality rules"]) == Counter(quality(rows))
    kept = done["quality rules"]
    roots = brute.jaccard_components([r[:2] for r in kept], 5, 80, 100)
    lead = {c for _, c in roots.values()}
    want = list(dict.fromkeys(r for r in kept if r[0] is None or r[0] in lead))     # of equal rows one stays
    assert Counter(done["n-gram Jaccard join"]) == Counter(want) and len(want) < len(kept)
    items = corpus()[1]
    clean = [r for r in want if not hits(r[1], items, 10)[1]]
    assert Counter(done["benchmark decontamination"]) == Counter(clean)
    assert {112, 113} & {r[0] for r in want} and not {112, 113} & {r[0] for r in clean}
    mix, have = Counter(done["mixing"]), Counter(clean)
    assert set(mix) <= set(have) and all(mix[r] <= 2 * have[r] for r in mix)
    size = sum(len(r[1].split()) for r in clean)
    assert abs(sum(len(r[1].split()) for r in done["mixing"]) - 1.5 * size) < 0.1 * size

    plain, at, expect = Tokenizer.from_str(tokenizer_json()), 0, []
    for r in sorted(done["mixing"], key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain.encode(r[1], add_special_tokens=False).ids + [1]
        expect.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert Counter(map(tuple, last.collect())) == Counter(expect)
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(expect)


def test_copies_under_repeated_and_null_ids(spark):
    rng = random.Random(21)
    a, b, c, d, e = (words(rng, 60, 10**6) for _ in range(5))
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (7, b, "s"), (None, a + " x", "s"), (None, c, "t"), (None, c, "s"),
            (None, "", "s"), (None, "", "s"), (None, None, "s"), (9, d, "s"), (9, d, "s"), (8, e, "s"), (8, e + " y", "s")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], FIELDS).repartition(3)
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    eight = [k for k in got if k[0] == 8]
    assert len(eight) == 1 and got[eight[0]] == 1       # the text hash decides which
    want = [(1, a, "s"), (5, b, "s"), (None, c, "s"), (None, "", "s"), (None, "", "s"), (None, None, "s"),
            (9, d, "s"), eight[0]]
    assert got == Counter(want)


def test_pipeline_on_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
