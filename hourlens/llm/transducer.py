"""Minimal acyclic transducers: sorted terms in, each term's place among them out.

``build`` lays terms (bytes, ascending, distinct) out as a trie in order and merges equal ends from the last node
back: a list of edges is named by its first edge (byte, does a term end there, the list below, the list beside), so
equal lists get one name and the automaton is minimal.  An edge carries the number of terms that its
earlier siblings lead to; the sum along a term's edges, one more for each shorter term passed, is its ordinal.

``Lookup`` holds the edges of several transducers in one hash table and runs all words of a text buffer through
them at once, one byte of every word per step.
"""

from __future__ import annotations

import numpy as np

EDGE = np.dtype([("state", "<i4"), ("byte", "u1"), ("final", "u1"), ("target", "<i4"), ("add", "<i4")])
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _shared(a: bytes, b: bytes) -> int:
    """Bytes at which two terms begin alike."""
    if b.startswith(a):
        return len(a)
    return next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


def build(terms: list[bytes]) -> np.ndarray:
    """Edges of the transducer; state 1 is the root.  Terms may not be empty."""
    byte, child, beside, final = [0], [0], [0], [0]
    path, before = [0], b""
    for term in terms:
        k = _shared(before, term)
        old = path[k + 1] if len(path) > k + 1 else 0
        del path[k + 1:]
        for c in term[k:]:
            node = len(byte)
            if old:
                beside[old] = node
            else:
                child[path[-1]] = node
            old = 0
            byte.append(c)
            child.append(0)
            beside.append(0)
            final.append(0)
            path.append(node)
        final[path[-1]] = 1
        before = term
    # from the last node back: what is below or beside a node is named before it
    named: dict[tuple, int] = {}
    count, first = [0], [(0, 0, 0, 0)]
    name = [0] * len(byte)
    for node in range(len(byte) - 1, 0, -1):
        edge = byte[node], final[node], name[child[node]], name[beside[node]]
        at = named.get(edge)
        if at is None:
            at = named[edge] = len(count)
            first.append(edge)
            count.append(edge[1] + count[edge[2]] + count[edge[3]])
        name[node] = at
    root, out = name[child[0]], []
    heads = {root} | {edge[2] for edge in first}
    state = {head: i + 2 for i, head in enumerate(sorted(heads - {0, root}))} | {root: 1, 0: 0}
    for head in heads - {0}:
        at, earlier = head, 0
        while at:
            c, end, below, beside_ = first[at]
            out.append((state[head], c, end, state[below], earlier))
            earlier += end + count[below]
            at = beside_
    return np.array(out, EDGE)


def first_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of every word as one number that orders as they do; short words end in zeros."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(8):
        inside = starts + k < ends
        out = out << np.uint64(8) | np.where(inside, buf[np.where(inside, starts + k, 0)], 0).astype(np.uint64)
    return out


class Lookup:
    """Transducers of several vocabularies, each cut into ranges of terms.

    ``parts``: (vocabulary, first term, ordinal of the first term, edges), in order of terms inside a vocabulary."""

    def __init__(self, parts: list[tuple[str, bytes, int, np.ndarray]]):
        states, edges, self.ranges = 0, [], {}
        for name, term, ordinal, found in parts:
            raw = np.frombuffer(term, np.uint8)
            begin = first_bytes(raw, np.array([0]), np.array([len(raw)]))[0]
            kept = self.ranges.setdefault(name, [])
            kept.append((begin, states + 1, ordinal))
            laid = found.copy()
            laid["state"] += states
            laid["target"][found["target"] > 0] += states
            states += int(found["state"].max(initial=0))
            edges.append(laid)
        self.ranges = {k: tuple(np.array(x, t) for x, t in zip(zip(*v), (np.uint64, np.int64, np.int64)))
                       for k, v in self.ranges.items()}
        self._lay(np.concatenate(edges) if edges else np.empty(0, EDGE))

    def _lay(self, edges: np.ndarray) -> None:
        bits = max(4, int(2 * len(edges)).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(size, -1, np.int64)
        self.target, self.add = np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.final = np.zeros(size, np.uint8)
        key = edges["state"].astype(np.int64) << 8 | edges["byte"]
        slot, open_ = self._slot(key), np.arange(len(edges))
        while len(open_):
            free = open_[self.keys[slot[open_]] < 0]
            taken, who = np.unique(slot[free], return_index=True)
            won = free[who]
            self.keys[taken], self.target[taken] = key[won], edges["target"][won]
            self.add[taken], self.final[taken] = edges["add"][won], edges["final"][won]
            open_ = open_[self.keys[slot[open_]] != key[open_]]
            slot[open_] = (slot[open_] + 1) & (size - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for those without an edge."""
        slot, last = self._slot(key), len(self.keys) - 1
        seen = self.keys[slot]
        out = np.where(seen == key, slot, -1)
        open_ = np.flatnonzero((seen != key) & (seen >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & last
            seen = self.keys[slot[open_]]
            good = seen == key[open_]
            out[open_[good]] = slot[open_[good]]
            open_ = open_[~good & (seen >= 0)]
        return out

    def _run(self, buf, starts, ends, roots) -> np.ndarray:
        """Ordinal of every word inside the transducer at its root; -1: not a term of it."""
        out = np.full(len(starts), -1, np.int64)
        live, at, state, total = np.arange(len(starts)), starts, roots, np.zeros(len(starts), np.int64)
        while len(live):
            slot = self._find(state << 8 | buf[at])
            hit = slot >= 0
            live, slot, at, total = live[hit], slot[hit], at[hit] + 1, total[hit]
            total += self.add[slot]
            end, final = at == ends[live], self.final[slot]
            stop = end & (final > 0)
            out[live[stop]] = total[stop]
            go = ~end
            live, at, total = live[go], at[go], total[go] + final[go]
            state = self.target[slot[go]].astype(np.int64)
        return out

    def ordinals(self, name: str, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of every word ``buf[start:end]`` in the vocabulary, -1 for words it lacks."""
        out = np.full(len(starts), -1, np.int64)
        if name not in self.ranges:
            return out
        begin, root, base = self.ranges[name]
        head = first_bytes(buf, starts, ends)
        # the last range that begins below the word's first bytes, and those that begin with the same
        low = np.searchsorted(begin, head, "left") - 1
        high = np.searchsorted(begin, head, "right") - 1
        open_, part = np.flatnonzero(high >= 0), np.maximum(low, 0)
        while len(open_):
            own = part[open_]
            found = self._run(buf, starts[open_], ends[open_], root[own])
            good = found >= 0
            out[open_[good]] = found[good] + base[own[good]]
            part[open_] += 1
            open_ = open_[~good & (own < high[open_])]
        return out
