"""Periodic runs: every stretch of words that repeats with some period, from maximal pairs.

A maximal pair of a text is two equal stretches, at i < j, that differ in the word before and in the
word after.  Where the distance d = j - i is at most a third of their length l, the text from i to j + l has period d
and no neighbour extends it: it is a run as it stands.

1. Words become numbers (Arrow's dictionary, exact).  Suffixes of the texts in hand are ranked by two words,
   four, eight, ...; a suffix whose four words occur once in its text leaves at once, so what is sorted further
   are repeats.  Neighbours' common prefixes (LCP) follow in text order.
2. The LCP-interval tree is walked bottom-up with a stack.  A node holds its places, each in the class of the
   word on its left.  Where two children meet, places of the smaller one look for partners in the other list:
   their stretches differ on the right, so a partner of another left class at a fitting distance is a maximal
   pair.  The class lists of a node are kept as one list in order of place: only the next place on either
   side can be a partner at the smallest period, because a third place between two that overlap so far would make
   a smaller period.  Products of class lists, quadratic in the number of copies, are never formed.
3. One stretch may come with a multiple of its period as well; its smallest is the run's.

A text is searched in one piece, in about 100 bytes of arrays and lists per word that belongs to a repeat, 40 for others.

Defined results: a null, empty or white-space text has no words and no runs, its kept text is empty; rows are judged
one by one, so repeated rows and ids give equal rows and a null id is kept as it is; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from hourlens.llm import bytescan as bs
from hourlens.llm.common import small_batches

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
SHARED = 4              # words: what the first two rankings look at


def _ranked(order: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys sorted by ``order``: the place of each one's group in it, and is it alone there?"""
    new = np.append(True, key[order][1:] != key[order][:-1])[:len(order)]
    begin = np.flatnonzero(new)
    many = np.diff(np.append(begin, len(order)))
    return np.repeat(begin, many), np.repeat(many == 1, many)


def repeated_suffixes(words: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the suffixes that share four words with another of their text, text by text in order
    of their words' numbers."""
    n = len(words)
    text = bs.segment_ids(offs)
    end = offs[1:][text] if n else text

    def after(value: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
        """``value`` (counted from 1) ``step`` words on, 0 beyond the text's end."""
        to = at + step
        ok = to < end[at]
        return np.where(ok, value[np.where(ok, to, 0)] + 1, 0)

    at = np.arange(n)
    key = (text * (n + 1) + words + 1) * (n + 1) + after(words, at, 1) if (
        (len(offs) + 1) * (n + 2) ** 2 < 2**62) else None
    if key is None:                                     # too many for one number: rank the first word, then both
        first = np.unique(text * (n + 1) + words, return_inverse=True)[1]
        key = first * (n + 1) + after(words, at, 1)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    place, alone = _ranked(order, key)
    rank[order] = place
    open_, base, step = order[~alone], place[~alone], 2
    while len(open_):
        key = after(rank, open_, step)
        inner = np.lexsort((key, base))
        open_, base, key = open_[inner], base[inner], key[inner]
        pair = base * (n + 2) + key
        place, alone = _ranked(np.arange(len(open_)), pair)
        head = np.searchsorted(base, base)              # ranks stay inside the group's span
        rank[open_] = base + place - head
        if step == 2:
            kept = np.sort(open_[~alone])
        base, open_, step = (base + place - head)[~alone], open_[~alone], step * 2
    if not n or step == 2:
        return np.empty(0, np.int64)
    return kept[np.argsort(rank[kept])]


def common_prefixes(words: np.ndarray, limit: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in the order; ``limit``: its text's end."""
    before = dict(zip(suffixes[1:].tolist(), suffixes[:-1].tolist()))
    value, stop = memoryview(np.ascontiguousarray(words)), memoryview(np.ascontiguousarray(limit))
    out, length, last = {}, 0, -2
    for i in np.sort(suffixes).tolist():
        j = before.get(i)
        length = length - 1 if i == last + 1 and length > SHARED else 0
        last = i
        if j is None or stop[j] != stop[i]:             # first of all, or of its text
            length = 0
            continue
        most = stop[i] - max(i, j)
        while length < most and value[i + length] == value[j + length]:
            length += 1
        out[i] = length
    return np.array([out.get(i, 0) for i in suffixes.tolist()], np.int64)


def _meet(one: list, two: list, shared: int, left, found: dict, least: int, exponent: int) -> list:
    """Two children of a node that shares ``shared`` words: note the runs, return all places."""
    if len(one) < len(two):
        one, two = two, one
    spots = [bisect_left(one, x) for x in two]
    reach = shared // (exponent - 1)
    for k, (x, spot) in enumerate(zip(two, spots)):
        if spot and (k == 0 or spots[k - 1] != spot):               # the place before x is not its sibling
            y = one[spot - 1]
            if x - y <= reach and shared + x - y >= least and left[x] != left[y]:
                found[y, shared + x - y] = min(x - y, found.get((y, shared + x - y), x - y))
        if spot < len(one) and (k + 1 == len(two) or spots[k + 1] != spot):
            y = one[spot]
            if y - x <= reach and shared + y - x >= least and left[x] != left[y]:
                found[x, shared + y - x] = min(y - x, found.get((x, shared + y - x), y - x))
    if len(two) * 8 > len(one):
        one += two
        one.sort()                                      # two sorted runs: one merge
    else:
        for x in two:
            one.insert(bisect_left(one, x), x)
    return one


def maximal_runs(words: np.ndarray, offs: np.ndarray, least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT
                 ) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of some texts laid end to end, by start, then period."""
    suffixes = repeated_suffixes(words, offs)
    if not len(suffixes):
        return []
    text = bs.segment_ids(offs)
    shared = common_prefixes(words, offs[1:][text], suffixes)
    # the class of a place: the word on its left; at a text's begin a class of its own
    left = np.append(-1, words[:-1])
    left[offs[:-1][offs[:-1] < len(words)]] = -1
    left = memoryview(left)
    low = max(exponent - 1, SHARED)                     # l >= (exponent - 1) d and l + d >= least
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, list]] = []
    node: list = []
    for at, depth in zip(suffixes.tolist(), shared.tolist()):
        if node:
            while stack and stack[-1][0] > depth:
                deep, other = stack.pop()
                node = _meet(other, node, deep, left, found, least, exponent)
            if depth >= low:
                if stack and stack[-1][0] == depth:
                    node = _meet(stack.pop()[1], node, depth, left, found, least, exponent)
                stack.append((depth, node))
        node = [at]
    while stack:
        deep, other = stack.pop()
        node = _meet(other, node, deep, left, found, least, exponent)
    return sorted((s, n, p) for (s, n), p in found.items())


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and kept, the text without
    a run's words after its first period, words joined by one space."""
    small_batches(docs.sparkSession)
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches):
        for batch in batches:
            _, bounds = bs.buffers(batch["text"])
            for i, j in bs.groups(bounds):
                part = batch.slice(i, j - i)
                names, words, offs = bs.word_numbers(part["text"])
                runs = maximal_runs(words, offs)
                start, length, period = np.array(runs, np.int64).reshape(-1, 3).T
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                keep = np.cumsum(edge)[:-1] == 0
                own = np.searchsorted(start, offs)
                base = offs[bs.segment_ids(own)]
                flat = pa.StructArray.from_arrays(
                    [pa.array(start - base), pa.array(length), pa.array(period)], fields=list(kind))
                left = np.append(0, np.cumsum(keep))[offs]
                kept = pc.binary_join(pa.LargeListArray.from_arrays(
                    pa.array(left), names.take(pa.array(words[keep]))), pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(np.diff(offs)), pa.ListArray.from_arrays(
                        pa.array(own, pa.int32()), flat), kept.cast(pa.string())],
                    ["doc_id", "n_words", "runs", "kept"])

    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, "
        "runs array<struct<start:long,length:long,period:long>>, kept string")
