"""Plain Python versions of the operators, written from their definitions."""

import re
from collections import defaultdict

SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = SPACE_WORD.findall((text or "").translate(AZ))
    if not w:
        return frozenset()
    k = min(n, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard_components(rows, n, p, q):
    """{doc_id: (set size, component)} for distinct non-null ids."""
    sets = {d: shingles(t, n) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and q * len(x & y) >= p * len(x | y):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeated_bytes(rows, size):
    """{doc_id: removed byte flags} for rows (doc_id, text) of distinct ids."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - size + 1):
            s = raw[p:p + size]
            if s in seen:
                gone[p:p + size] = b"\1" * size
            seen.add(s)
        out[d] = gone
    return out


def phrase_places(text, phrase):
    w, parts = ALNUM_WORD.findall((text or "").translate(AZ)), phrase.split()
    return [i for i in range(len(w) - len(parts) + 1) if w[i:i + len(parts)] == parts]


def line_first_owner(rows, min_chars):
    """{key: smallest doc_id} of keys in two documents or more."""
    held = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(AZ)
            if len(key) >= min_chars:
                held[key].add(d)
    return {k: min(v) for k, v in held.items() if len(v) > 1}
