"""Transducers and the source divergence audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hourlens.llm import source_audit, transducer

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


@given(st.sets(st.binary(min_size=1, max_size=12).filter(lambda b: 0 not in b), min_size=1, max_size=60),
       st.lists(st.binary(min_size=1, max_size=12).filter(lambda b: 0 not in b), max_size=20), st.integers(1, 5))
@settings(deadline=None, max_examples=150)
def test_ordinals(terms, others, step):
    terms = sorted(terms)
    parts = [("x", terms[a], a, transducer.build(terms[a:a + step])) for a in range(0, len(terms), step)]
    lookup = transducer.Lookup([("other", terms[0], 0, transducer.build(terms[:1])), *parts])
    probe = terms + others + [t + b"a" for t in terms] + [t[:-1] for t in terms if len(t) > 1]
    at = np.cumsum([0] + [len(t) for t in probe])
    place = {t: i for i, t in enumerate(terms)}
    got = lookup.ordinals("x", np.frombuffer(b"".join(probe), np.uint8), at[:-1], at[1:])
    assert got.tolist() == [place.get(t, -1) for t in probe]
    assert (lookup.ordinals("none", np.frombuffer(b"".join(probe), np.uint8), at[:-1], at[1:]) == -1).all()


def test_automaton_is_minimal():
    ends = [b"s", b"ed", b"ing", b"er", b"ers"]
    terms = sorted(a + b for a in (b"walk", b"talk", b"work", b"w", b"jump") for b in ends)
    edges = transducer.build(terms)
    # states are as many as there are different sets of ways on
    left = {frozenset(t[k:] for t in terms if t.startswith(p)) for p in
            {t[:k] for t in terms for k in range(len(t))} for k in [len(p)]}
    ways = {frozenset(x for x in s if x) for s in left}
    assert len(set(edges["state"].tolist())) == len(ways)


def audit(rows, least=3, ranks=200):
    """Rows of (lang, source, text); the audit from its definition."""
    rows = [(a or "", b or "", TERM.findall((t or "").translate(brute.AZ))) for a, b, t in rows]
    held = Counter((lang, t) for lang, _, w in rows for t in set(w))
    kept, out = defaultdict(list), []
    for (lang, t), n in held.items():
        if n >= least:
            kept[lang].append(t)
    count = Counter((lang, s, t) for lang, s, w in rows for t in w)
    whole = Counter((lang, t) for lang, _, w in rows for t in w)
    by = defaultdict(set)
    for lang, s, _ in rows:
        by[lang].add(s)

    def share(c, n, v):
        return 1 + 10**9 * (c + 1) // (n + v)
    for lang, sources in by.items():
        terms = kept[lang]
        v = len(terms)
        n = {s: sum(count[lang, s, t] for t in terms) for s in sources}
        p = {s: {t: share(count[lang, s, t], n[s], v) for t in terms} for s in sources}
        total = sum(n.values())
        q = {t: share(whole[lang, t], total, v) for t in terms}
        for s in sources:
            found = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in terms), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, x, i + 1) for i, (x, o) in enumerate(
                sorted(found, key=lambda z: (-z[0], z[1].encode())))]
            found = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in terms if count[lang, s, t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, x, i + 1) for i, (x, t) in enumerate(
                sorted(found, key=lambda z: (-z[0], z[1].encode()))[:ranks])]
    return out


def corpus():
    rng = random.Random(6)
    names = [f"t{''.join(rng.choice('abcdé') for _ in range(rng.randint(1, 9)))}" for _ in range(300)]
    rows = []
    for i in range(250):
        s = rng.choice(["a", "a", "a", "b", "c", "ü", "zz", None])
        rows.append((rng.choice(["en", "en", "fr", None]), s, " ".join(rng.choice(names[:40 + 30 * len(s or "")])
                                                                    for _ in range(rng.randrange(60)))))
    rows += [("en", "empty", None), ("en", "b", ""), ("xx", "p", "one two"), ("xx", "q", None), ("yy", "only", "a b"),
             ("fr", "a", "É é E e A1a-b_c"), ("fr", "a", "É é E e A1a-b_c"), ("fr", None, "ée " * 700)]
    rows += [("long", f"s{i}", f"{'x' * 3000}{i % 2} y") for i in range(7)]
    rows += [("many", f"s{i:03}", f"w{i % 9} w{i % 4} w") for i in range(70)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, a, b, 0) for i, (a, b, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    for c in ("term", "docs", "block", "ordinal", "part", "at", "tile", "words", "count", "terms", "zero", "p", "q", "item"):
        df = df.selectExpr("*", f"'x' AS {c}")
    return df


def test_audit(spark):
    rows = corpus()
    got = Counter(map(tuple, source_audit.audit(frame(spark, rows)).collect()))
    assert got == Counter(audit(rows)) and len(got) > 3000


def test_audit_in_many_parts_and_passes(spark, monkeypatch):
    for name, value in (("PART_BYTES", 400), ("PASS_BYTES", 900), ("CELL_TERMS", 7), ("TILE", 3)):
        monkeypatch.setattr(source_audit, name, value)
    rows = [r for r in corpus() if r[0] != "many"] + [("many", f"s{i:03}", f"w{i % 9} w{i % 4} w") for i in range(8)]
    got = Counter(map(tuple, source_audit.audit(frame(spark, rows), ranks=9).collect()))
    assert got == Counter(audit(rows, ranks=9))


def test_nothing_to_audit(spark):
    assert source_audit.audit(frame(spark, corpus()).limit(0)).count() == 0
    rows = [("en", "a", None), ("en", "b", "x y")]
    assert Counter(map(tuple, source_audit.audit(frame(spark, rows)).collect())) == Counter(audit(rows))
