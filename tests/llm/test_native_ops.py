"""URL filters, sharding, line de-duplication, mixing, license scans against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from hourlens.llm import license_scan, line_dedup, mixing, sharding, url_filters

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.example.org", "/es/x", "allow"),
         ("example.org", "/es/x/y", "block"), ("org", "/", "block"), (None, "/", "block"),
         ("net", None, "block")]


def judged(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1).translate(brute.AZ), m.group(2)) if m else ("", "")
    best = None
    for h, p, v in rules:
        p = p or ""
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best, (len(h) + len(p), len(h), h + p, v)) if best else (len(h) + len(p), len(h), h + p, v)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x/y?q", "http://example.org",
            "x://b.com/de/", "https://m.com/fr/1#t", "http://exampleorg/es/", "http://.org/", "http://org./",
            "http://a.b.example.org/en/12", "http://example.org/en/2", "x://y://z.org/", "http://é.net/ü",
            "http://" + "a." * 3000 + "org/" + "p" * 20000, "http://notexample.org/es/x"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "*", "'x' AS host", "1 AS block", "2 AS key", "3 AS depth")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filters.judge_urls(pages, rules).collect()}
    assert got == {i: judged(u, RULES) for i, u in enumerate(urls)}
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0
    none = url_filters.judge_urls(pages, rules.limit(0))
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "allow")}


def test_url_sweep_carries_rules_over_blocks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        urls = [f"http://{h}.org/{p}/{i}" for i in range(40) for h in "abc" for p in ("x", "x/y", "z")]
        rules = [("org", "/", "allow"), ("org", "/x", "block"), ("b.org", "/x/y/1", "block"), ("c.org", "", "block")]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = {r["page_id"]: tuple(r)[1:] for r in url_filters.judge_urls(pages, table).collect()}
        assert got == {i: judged(u, rules) for i, u in enumerate(urls)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


LINES = [(1, "One line of text here\nshort\nshared boilerplate line"), (2, " SHARED boilerplate LINE \nshort\n"),
         (3, None), (4, ""), (5, "shared boilerplate line\nown words of five\nshared boilerplate line"),
         (None, "shared boilerplate line\nowner is null here"), (7, "owner is null here"), (8, "\n\n\n"),
         (9, "twice in one doc\ntwice in one doc"), (10, "x" * 300000 + "\nshared boilerplate line"),
         (2, " SHARED boilerplate LINE \nshort\n")]


@pytest.mark.parametrize("parts", ["4", "17"])
def test_line_dedup(spark, docs_of, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = line_dedup.dedup_lines(docs_of(LINES, extra=True)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    inf = 10**9
    owner = brute.line_first_owner([(inf if d is None else d, t) for d, t in LINES], 10)
    want = Counter()
    for d, text in LINES:
        lines = (text or "").split("\n")
        keep = [x for x in lines if owner.get(x.strip(" \t\n\x0b\x0c\r").translate(brute.AZ),
                                              inf if d is None else d) == (inf if d is None else d)]
        want[d, len(lines), len(lines) - len(keep), "\n".join(keep)] += 1
    assert Counter(tuple(r) for r in rows) == want
    assert line_dedup.dedup_lines(docs_of([])).count() == 0


def test_line_bitmaps_are_runs(docs_of):
    maps = line_dedup.keep_bitmaps(docs_of([(1, "aaaaaaaaaa\nbbbbbbbbbb"), (2, "x\naaaaaaaaaa\ny\nbbbbbbbbbb")]))
    assert [(r["doc_id"], [tuple(k) for k in r["keep"]]) for r in maps.collect()] == [(2, [(0, 1), (2, 1)])]


def test_mixing(spark, docs_of):
    rows = [(i, "w " * (i % 37), f"s{i % 3}") for i in range(600)] + [(600, None, None), (601, "a b", None),
                                                                     (602, "", "empty"), (7, "w " * 7, "s1")]
    docs = docs_of(rows, extra=False)
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(rows)
    again = mixing.mix_documents(docs.repartition(9)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    total = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        total[r["source_size"], r["target"]] += r["taken"]
    size = sum(len((t or "").split()) for _, t, _ in rows)
    assert abs(sum(t for _, t in total) - 1.5 * size) < 1e-6
    for (own, target), taken in total.items():
        assert target <= 2 * own and abs(taken - target) <= 80
    assert mixing.mix_documents(docs_of([])).count() == 0
    assert mixing.mix_documents(docs_of([(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0


def test_targets_are_dealt_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90), ("d", 0)],
                                  "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    size = {"a": 10, "b": 1000, "c": 500, None: 90, "d": 0}
    want, free, left = {}, set(size), 1.5 * 1600
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * size[s]}
        if not full:
            break
        for s in full:
            want[s], left = 2 * size[s], left - 2 * size[s]
        free -= full
    assert got == pytest.approx(want | share)


@pytest.mark.parametrize("limit", [300, 1000, 10**9])
def test_sharding(spark, docs_of, limit):
    rows = [(i, "é" * (i % 90)) for i in range(400)] + [(5, "same key " * 9)] * 40 + [
        (None, None), (900, "z" * 5000), (901, "")]
    got = sharding.shard(docs_of(rows, extra=True), limit).collect()
    assert Counter((r["doc_id"], r["n_bytes"]) for r in got) == Counter((d, len((t or "").encode())) for d, t in rows)
    size = Counter()
    for r in got:
        size[r["shard"]] += r["n_bytes"]
    for r in got:
        assert size[r["shard"]] == r["shard_bytes"]
        assert r["shard_bytes"] <= limit or (r["n_bytes"] == 5000 == r["shard_bytes"])
        if "+" not in r["shard"]:
            bits = f"{int(hashlib.md5(str(r['doc_id'] if r['doc_id'] is not None else 'null').encode()).hexdigest()[:16], 16):064b}"
            assert bits.startswith(r["shard"]) and len(r["shard"]) == r["depth"]
    # no bucket was split that fitted
    names = {s for s in size if "+" not in s}
    for s in names:
        twin = s[:-1] + ("1" if s.endswith("0") else "0") if s else None
        if twin in names:
            assert size[s] + size[twin] > limit
    assert sharding.shard(docs_of([]), limit).count() == 0


def licenses(text):
    """Labels and score by plain ``re`` over every rule, without gates."""
    words = brute.ALNUM_WORD.findall((text or "").translate(brute.AZ))
    spaced = " " + " ".join(words) + " "
    found = []
    for i, label, key, rx, priority, score in license_scan.rules():
        for m in re.finditer(rx, spaced):
            a = spaced[:m.start()].count(" ")
            found.append((a, a + m.group().count(" "), priority, i, label, score))
    found = sorted(set(found), key=lambda d: (d[0], -d[1], d[2], d[3]))
    left = [d for k, d in enumerate(found) if not any(e[1] >= d[1] and e[2] <= d[2] for e in found[:k])]
    base = sorted({lab for ph, lab in license_scan.BASE if brute.phrase_places(text, ph)})
    places = sorted(p for ph, _ in license_scan.BASE for p in brute.phrase_places(text, ph))
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None,
            ",".join(base), ",".join(sorted(set(base) | {d[4] for d in left})),
            max([0.0, 0.6 if base else 0.0] + [d[5] for d in left]))


LICENSED = ["", None, "MIT License", "mit-license MIT  LICENSE mit license", "Licensed under CC BY-NC 4.0.",
            "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-3.0-or-later x",
            "released under the terms of the GNU Lesser General Public License v2.1 or later",
            "Permission is hereby granted, free of charge, to any person obtaining a copy", "limit license",
            "GNU GENERAL PUBLIC LICENSE", "the general public license", "bsd 3-clause license; 2 clause BSD licence",
            "under mit", "distributed under vim", "all rights reserved é mit license é", "ISC_LICENSE"]


def test_license_scan(docs_of):
    rows = [(i, t) for i, t in enumerate(LICENSED)] + [(2, "MIT License"), (99, "w " * 50000 + "mit license " * 300)]
    got = license_scan.scan_licenses(docs_of(rows, extra=True)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, *licenses(t))) for d, t in rows)
    assert license_scan.scan_licenses(docs_of([])).count() == 0


def test_license_scan_whole_table(documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan_licenses(documents).collect()}
    want = {r["doc_id"]: licenses(r["text"]) for r in documents.collect()}
    assert got == want
    assert len(license_scan.rules()) >= 200


def scanned(docs_of, texts):
    """labels and score by text, after comparing every column with the rules run without gates."""
    rows = list(enumerate(texts))
    got = {r["doc_id"]: tuple(r) for r in license_scan.scan_licenses(docs_of(rows)).collect()}
    assert got == {d: (d, *licenses(t)) for d, t in rows}
    return [got[d][-2:] for d, _ in rows]


def test_license_names_with_joined_versions(docs_of):
    texts = ["Licensed under the GPLv3", "GPLv2 license", "under the terms of the LGPLv3: licensed under LGPLv3",
             "SPDX-License-Identifier: AGPLv3", "released under the terms of the GNU LGPLv2 license or later",
             "license is GPLv3, the gpl license", "gplv4 license"]
    assert scanned(docs_of, texts) == [("gpl", 0.8), ("gpl", 0.6), ("lgpl", 0.8), ("agpl", 0.9), ("lgpl", 0.8),
                                       ("gpl", 0.6), ("", 0.0)]


def test_license_gate_takes_underscores_for_gaps(docs_of):
    texts = ["Released _under_ the BSD", "distributed_under_vim", "funder_the BSD", "x_under9 the BSD"]
    assert scanned(docs_of, texts) == [("bsd", 0.8), ("vim", 0.8), ("", 0.0), ("", 0.0)]
