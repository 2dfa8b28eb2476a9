"""Jaccard join, token store, quality rules, decontamination, suffix de-duplication."""

import json
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourlens.llm import bytescan, decontaminate, ngram_join, quality_rules, suffix_dedup, token_store
from hourlens.llm.queries import tokenizer_json


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


# ---- word scanning

@given(st.lists(st.text(alphabet="aB é\t\n\x1c .-", max_size=30), max_size=6))
@settings(deadline=None, max_examples=60)
def test_words_of_many_texts(texts):
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    for member, rx, lower in ((bytescan.NOT_SPACE, brute.SPACE_WORD, False), (bytescan.ALNUM, brute.ALNUM_WORD, True)):
        got = [[] for _ in texts]
        for i, j, h, offs, starts, ends in bytescan.scan_words(buf, bounds, member, lower):
            for d in range(j - i):
                for a, b in zip(starts[offs[d]:offs[d + 1]], ends[offs[d]:offs[d + 1]]):
                    w = buf[a:b]
                    got[i + d].append(bytes(bytescan.LOWER[w] if lower else w).decode())
        assert got == [rx.findall(t.translate(brute.AZ) if lower else t) for t in texts]


def test_long_texts_hash_like_short_ones(monkeypatch):
    rng = random.Random(3)
    raw = np.frombuffer((words(rng, 900) + " " + "x" * 700).encode(), np.uint8)
    bounds = np.array([0, len(raw)])
    whole = next(bytescan.scan_words(raw, bounds, bytescan.NOT_SPACE, True))
    monkeypatch.setattr(bytescan, "PIECE", 256)
    cut = next(bytescan.scan_words(raw, bounds, bytescan.NOT_SPACE, True))
    assert all((a == b).all() for a, b in zip(whole[2:], cut[2:]))


# ---- n-gram Jaccard join

def near_rows(seed=5):
    rng, rows = random.Random(seed), []
    for g in range(12):
        base = words(rng, rng.choice([3, 8, 60, 200]))
        rows += [edited(rng, base, rng.choice([0, 0.01, 0.03])) for _ in range(rng.randrange(1, 9))]
    chain = words(rng, 120, 10**6).split()
    rows += [" ".join(chain[k:k + 100]) for k in range(0, 20, 2)]          # linked only in steps
    rows += ["", None, " \t ", "a", "A", "a b", "a  B", "a b c", rows[3].upper(), "é ü", "é ü"]
    return list(enumerate(rows))


@pytest.mark.parametrize("n,ratio,block", [(3, (90, 100), 4096), (5, (80, 100), 3)])
def test_jaccard_components(docs_of, monkeypatch, n, ratio, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_rows()
    got = ngram_join.link_components(docs_of(rows, extra=True), n, ratio, sketch_bits=16).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard_components(rows, n, *ratio)
    assert len(got) == len(rows)


def test_jaccard_nulls_and_repeats(docs_of):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "A b c d")]
    got = ngram_join.link_components(docs_of(rows), sketch_bits=16).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 2, None), (4, 2, 2), (4, 2, 2), (2, 2, 2)], key=str)
    assert ngram_join.link_components(docs_of([]), sketch_bits=16).count() == 0


def dealt_rows(monkeypatch):
    """Collects (all rows, rows of the largest task) of every comparison inside tiles."""
    seen, across = [], ngram_join._across

    def spy(laid, *rest):
        held = [r["count"] for r in laid.groupBy("token", "to_band", "block").count().collect()]
        seen.append((sum(held), max(held, default=0)))
        return across(laid, *rest)

    monkeypatch.setattr(ngram_join, "_across", spy)
    return seen


@pytest.mark.parametrize("ratio,own", [((90, 100), 15), ((80, 100), 30)])
def test_template_pages_that_do_not_link_never_meet(docs_of, monkeypatch, ratio, own):
    rng, seen = random.Random(17), dealt_rows(monkeypatch)
    page = words(rng, 200, 10**6)
    rows = [(i, page + " " + words(rng, own, 10**6)) for i in range(60)]
    got = ngram_join.link_components(docs_of(rows), 3, ratio).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard_components(rows, 3, *ratio)
    assert len({r[2] for r in got}) == len(rows) and not any(n for n, _ in seen)


def test_unlinked_guests_are_cut_into_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng, seen = random.Random(18), dealt_rows(monkeypatch)
    menu = [words(rng, 10, 10**6) for _ in range(40)]
    rows = [(i, " ".join(p for p in menu if rng.random() < 0.5)) for i in range(160)]
    got = ngram_join.link_components(docs_of(rows), 3, (80, 100)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard_components(rows, 3, 80, 100)
    assert any(n for n, _ in seen) and max(m for _, m in seen) <= 6 * 8


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.97], rng.integers(0, 2**63, 3).astype(np.uint64)]))
        bits = [np.frombuffer(ngram_join.parity_bitmap(x), np.uint64).reshape(1, -1) for x in (a, b)]
        assert ngram_join.differing_bits(*bits)[0] <= len(np.setxor1d(a, b))


# ---- token store

@pytest.fixture(scope="module")
def model():
    return tokenizer_json()


def encoded(encoder, texts):
    raw = [t.encode("utf-8", "ignore") for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return encoder.encode(np.frombuffer(b"".join(raw), np.uint8), bounds, 1)


TRICKY = st.lists(st.sampled_from(
    ["a", "H", "\u0331", "\u0301", "É", "é", ".", ",", "!?", "'s", "'", "\u2019", "9", "<", "|", "\u0338", " ",
     "\n", "\x1c", "\x85", "\u3000", "İ", "ß", "ſ", "Σ", "ς", "中", "\u0130", "K", "<|ENDOFTEXT|>", "x.Y,", "×", "÷", "à.", "€", "ŉ"]),
    max_size=12).map("".join)


@given(st.lists(st.one_of(TRICKY, st.text(max_size=60)), max_size=5))
@settings(deadline=None, max_examples=600)
def test_chunks_encode_like_whole_texts(texts):
    model = _cached_model()
    texts += ["á ̸x Ǻ", "It's <|endoftext|> x<|startoftext|>", "\x0b\x1c\x85  a b"]
    ids, offs = encoded(model[1], texts)
    for k, t in enumerate(texts):
        t = t.encode("utf-8", "ignore").decode()
        assert ids[offs[k]:offs[k + 1]].tolist() == model[0].encode(t, add_special_tokens=False).ids + [1]


_MODEL = []


def _cached_model():
    if not _MODEL:
        text = tokenizer_json()
        _MODEL.extend([Tokenizer.from_str(text), token_store.Encoder(text)])
    return _MODEL


def test_encoder_forgets_and_goes_on(monkeypatch, model):
    monkeypatch.setattr(token_store, "CACHE", 3)
    enc, plain = token_store.Encoder(model), Tokenizer.from_str(model)
    for k in range(5):
        ids, _ = encoded(enc, [f"one{k} two{k} three{k} four"])
        assert ids.tolist() == plain.encode(f"one{k} two{k} three{k} four", add_special_tokens=False).ids + [1]


def test_another_tokenizer_is_not_guessed(docs_of, spark, tmp_path):
    other = tokenizer_json("byte_bpe_50k.json")
    changed = json.loads(tokenizer_json())
    changed["normalizer"]["normalizers"] = changed["normalizer"]["normalizers"][:2]         # keeps capitals
    assert token_store.by_chunks(json.loads(tokenizer_json()))
    texts = ["Two  Words\n and<|endoftext|> more", "", " lead", "É é don't  STOP!!", "x" * 500, None]
    for name, text in (("bytes", other), ("capitals", json.dumps(changed))):
        assert not token_store.by_chunks(json.loads(text))
        plain, path = Tokenizer.from_str(text), f"{tmp_path}/{name}"
        token_store.write_tokens(docs_of(list(enumerate(texts))).repartition(3), path, text)
        got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_store.checksums(spark, path).collect()}
        for d, t in enumerate(texts):
            ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
            assert got[d] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), (name, d)


def test_token_round_trip(spark, documents, docs_of, model, tmp_path):
    plain = Tokenizer.from_str(model)
    docs = documents.select("doc_id", "text").unionByName(
        docs_of([(None, "null id"), (10**9, None), (10**9 + 1, ""), (3, "again")]).select("doc_id", "text"))
    path = str(tmp_path / "store")
    token_store.write_tokens(docs.repartition(7), path, model)
    got = token_store.checksums(spark, path).collect()
    want, at = {}, 0
    rows = sorted(docs.collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    for d, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault(d, []).append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    for r in got:
        if r["doc_id"] != 3:                            # two rows share it, in either order
            assert tuple(r)[1:] in want[r["doc_id"]]
    assert {tuple(r) for r in token_store.read_metadata(spark, path).collect()} == {tuple(r)[:3] for r in got}
    some = token_store.read_tokens(spark, path, 5, 7)
    assert [r["doc_id"] for r in some.orderBy("doc_id").collect()] == [5, 6, 7]
    plan = token_store.read_metadata(spark, path)._jdf.queryExecution().toString()
    assert "ids" not in plan[plan.index("Physical Plan"):]
    empty = str(tmp_path / "none")
    token_store.write_tokens(docs_of([]), empty, model)
    assert token_store.checksums(spark, empty).count() == 0


# ---- quality rules

def measures(text):
    w = brute.SPACE_WORD.findall(text or "")
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(grams)
    hit = {k for i, g in enumerate(grams) if many[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if brute.SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit))


QUALITY = [None, "", "\n\n", "a\nA\n a \na", "x y z x y z", "#*$%&|<> é €\n#*$%&|<> é €", "a b c\n" * 40,
           "no newline at the end\n", "\r\n\r\nx\r\nx\r", "x" * 5000 + "\n" + "y z " * 900]


@pytest.mark.parametrize("piece", [1 << 20, 300])
def test_measures(docs_of, documents, monkeypatch, piece):
    rng = random.Random(1)
    rows = list(enumerate(QUALITY + [words(rng, 200, 30) + "\n" + words(rng, 5, 9) for _ in range(20)]))
    docs = docs_of(rows, extra=True).withColumn("host", F.lit("h"))
    if piece != 1 << 20:
        raw = [(t or "").encode() for _, t in rows]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        monkeypatch.setattr(bytescan, "PIECE", piece)
        parts = [quality_rules._run(buf, bounds, *run)
                 for run in bytescan.scan_words(buf, bounds, bytescan.NOT_SPACE, False)]
        got = list(zip(*[np.concatenate(c).tolist() for c in list(zip(*parts))[:5]]))
        assert got == [measures(t) for _, t in rows]
        return
    got = {r["doc_id"]: tuple(r)[3:8] for r in quality_rules.measure(docs).collect()}
    assert got == {d: measures(t) for d, t in rows}


def test_boilerplate_and_depleted(spark, docs_of):
    rng = random.Random(4)
    body = [words(rng, 80, 10**6) for _ in range(100)]
    menu = "Home About  Contact " + words(rng, 60, 10**6)
    rows = [(i, body[i] + ("\n  " + menu.upper() if i % 2 else ""), "a") for i in range(100)]
    rows += [(200 + i, menu + f"\nfoot{i} " + "own words here " + f"z{i}", "a") for i in range(3)]
    rows += [(300 + i, menu + "\n" + words(rng, 20, 10**6), "b") for i in range(5)]
    rows += [(400 + i, body[0], None) for i in range(60)]                   # copies of one text count once
    docs = docs_of(rows).withColumnRenamed("source", "host")
    verdict, lines = quality_rules.judge(docs)
    got = {r["doc_id"]: r for r in verdict.collect()}
    assert len(got) == len(rows)
    assert {d for d, r in got.items() if r["lost_words"]} == {i for i in range(1, 100, 2)} | {200, 201, 202}
    assert {d for d, r in got.items() if not r["kept"]} == {200, 201, 202}
    joined = docs.withColumn("text_hash", F.xxhash64("text")).join(
        lines.drop("host"), "text_hash", "left")
    left = {r["doc_id"]: r["text"] for r in quality_rules.without_lines(joined, ["doc_id"]).collect()}
    assert left[1] == body[1] and left[2] == body[2] and menu in left[300]
    assert quality_rules.judge(docs.limit(0))[0].count() == 0


def test_frequent_lines_of_a_hot_host(docs_of):
    rng = random.Random(14)
    line = "Subscribe to our letter " + words(rng, 9, 10**6)
    rows = [(i, words(rng, 60, 10**6) + (f"\n{line}" if i < 30 else ""), "hot") for i in range(900)]
    rows += [(1000 + i, f"copied {line}\n" + rows[0][1].split("\n")[0], "twice") for i in range(40)]
    docs = docs_of(rows).withColumnRenamed("source", "host")

    def losing(**limits):
        return {r["doc_id"] for r in quality_rules.judge(docs, **limits)[0].where("lost_words > 0").collect()}

    assert losing() == set()                        # 30 of 900 is under the share
    assert losing(most=29) == set(range(30))        # but over an absolute limit
    assert losing(most=30) == set()
    assert losing(copies=True) == set(range(1000, 1040))


# ---- decontamination

def hits(text, items, n):
    w = brute.ALNUM_WORD.findall((text or "").translate(brute.AZ))
    marked, ids = set(), set()
    for item, t in items:
        v = brute.ALNUM_WORD.findall((t or "").translate(brute.AZ))
        k = min(n, len(v))
        windows = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in windows:
                marked |= set(range(i, i + k))
                ids.add(item)
    return len(w), marked, ids


@pytest.mark.parametrize("most", [10**6, 7])
def test_decontamination(spark, docs_of, most):
    rng = random.Random(9)
    items = [(1, words(rng, 30, 900)), (2, "Two-Words!"), (3, None), (4, "..."), (5, words(rng, 12, 900)),
             (5, "other text of a repeated id"), (None, "id is null here ok")]
    rows = [words(rng, 40, 900), None, "", "two words", "TWO, words two words", items[0][1].upper().replace(" ", "-"),
            "x " + " ".join(items[0][1].split()[5:16]) + " y", items[4][1][:-3], items[4][1] + " " + items[4][1],
            "id is null here ok", "é two words é", " ".join(items[0][1].split()[:9]), "other text of a repeated id"]
    rows = list(enumerate(rows)) + [(3, "two words"), (None, "two words")]
    docs = docs_of(rows, extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS hash", "2 AS words")
    got = decontaminate.find_hits(docs, bench, 10, most).collect()
    seen = Counter()
    for r in got:
        marked = {k for s in r["spans"] for k in range(s["start"], s["end"])}
        seen[r["doc_id"], r["n_words"], frozenset(marked), frozenset(r["items"])] += 1
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    want = Counter()
    for d, t in rows:
        n, marked, ids = hits(t, items, 10)
        want[d, n, frozenset(marked), frozenset(ids)] += 1
    assert seen == want
    assert decontaminate.find_hits(docs.limit(0), bench).count() == 0
    assert all(not r["spans"] for r in decontaminate.find_hits(docs, bench.limit(0)).collect())
    assert decontaminate.remove_spans(["a b, two words; c", None], [[{"start": 2, "end": 4}], []]) == ["a b, \n; c", None]


# ---- suffix de-duplication

@pytest.mark.parametrize("alphabet", ["ab", "a\0\xff"])
def test_column_sort(alphabet):
    rng = random.Random(alphabet)
    for _ in range(60):
        parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))).encode("latin-1")
                 for _ in range(rng.randint(1, 6))]
        size = rng.randint(1, 5)
        place = np.array(sorted(rng.sample(range(100), len(parts)))) << 40
        owner, window = suffix_dedup.repeated_windows(parts, place, size)
        seen, want = set(), []
        for k, f in enumerate(parts):
            for w in range(len(f) - size + 1):
                if f[w:w + size] in seen:
                    want.append((k, w))
                seen.add(f[w:w + size])
        assert sorted(zip(owner.tolist(), window.tolist())) == want


def suffix_rows():
    rng = random.Random(8)
    base = [words(rng, 60, 10**5) for _ in range(6)]
    rows = [base[0], base[0], edited(rng, base[0], 0.05), base[1] + base[2], base[2][30:] + base[1][:170], None, "",
            "short", "x" * 350, "ab" * 200, base[3] + base[3], "é" * 120 + base[4], base[4][11:] + "é" * 60,
            base[5][:99], base[5][:100], base[5][:101]]
    rows += [edited(rng, base[5], 0.04) for _ in range(12)]
    return [(k * 3 % 101, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("size,gram,crowd", [(100, 24, 4096), (40, 7, 1), (12, 5, 3)])
def test_suffix_dedup(docs_of, size, gram, crowd):
    rows = suffix_rows()
    got = suffix_dedup.dedup_bytes(docs_of(rows, extra=True).repartition(5), size, gram, crowd).collect()
    want = brute.repeated_bytes(rows, size)
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        gone = bytearray(r["n_bytes"])
        for s in r["runs"]:
            gone[s["start"]:s["end"]] = b"\1" * (s["end"] - s["start"])
        assert gone == want[r["doc_id"]], r["doc_id"]
        raw = (text[r["doc_id"]] or "").encode()
        assert bytes(r["kept"]) == bytes(b for b, g in zip(raw, gone) if not g)
        assert all(a["end"] < b["start"] for a, b in zip(r["runs"], r["runs"][1:]))


@pytest.mark.parametrize("crowd", [4096, 20])
def test_one_passage_between_unique_ends(docs_of, crowd):
    rng = random.Random(23)
    short, long = words(rng, 40, 10**6)[:70], words(rng, 60, 10**6)[:130]
    rows = [(i, words(rng, 9, 10**6) + (short if i % 3 else long) + words(rng, 9, 10**6)) for i in range(90)]
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    got = suffix_dedup.dedup_bytes(docs_of(rows).repartition(6), crowd=crowd).collect()
    want = brute.repeated_bytes(rows, 100)
    for r in got:
        gone = bytearray(r["n_bytes"])
        for s in r["runs"]:
            gone[s["start"]:s["end"]] = b"\1" * (s["end"] - s["start"])
        assert gone == want[r["doc_id"]], r["doc_id"]
    assert sum(map(any, want.values())) == 34


def test_suffix_dedup_repeated_rows(docs_of):
    text = words(random.Random(1), 40, 10**5)
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "tiny")]
    got = Counter((r["doc_id"], len(r["kept"])) for r in suffix_dedup.dedup_bytes(docs_of(rows)).collect())
    assert got == Counter([(1, len(text)), (1, len(text)), (2, 0), (None, 0), (None, 4)])
    assert suffix_dedup.dedup_bytes(docs_of([])).count() == 0


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(6)
    raw = np.frombuffer(words(rng, 300, 50).encode(), np.uint8)
    monkeypatch.setattr(bytescan, "PIECE", 500)
    covered = Counter()
    for _, part, own, shift in suffix_dedup._pieces(raw, np.array([0, len(raw)]), 100):
        for _, p, n, _, _ in zip(*suffix_dedup.stretches(part, own, 100, 24)):
            covered.update(range(p + shift, p + shift + n))
    assert covered == Counter(range(len(raw) - 99))
