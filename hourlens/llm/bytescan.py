"""Numpy scanning of UTF-8 text: words and their hashes for many documents at once.

Both word classes in use are decided by single bytes (every byte of a non-ASCII character is a
word byte), so no text is decoded.  Arrays per byte cover at most ``PIECE`` bytes of text, or one
word if a word is longer, whatever the length of a document; what is kept per word (hash, start and end, 24
bytes) grows with the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~SPACE                       # words [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, bool)              # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, lower-cased
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_P = 0x9E3779B97F4A7C15 | 1


def _powers_of(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_INVERSE = pow(_P, -1, 2**64)


@cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers_of(_P, 1 << 20), _powers_of(_INVERSE, 1 << 20)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    if n <= 1 << 20:                    # the driver never asks, so it never holds them
        pw, inv = _usual_powers()
        return pw[:n + 1], inv[:n + 1]
    return _powers_of(_P, n), _powers_of(_INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def window_sums(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` consecutive values."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    pw, inv = powers(len(values))
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw[:-1], out=c[1:])
    return (c[n:] - c[:-n]) * inv[:len(values) - n + 1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def find_words(buf: np.ndarray, bounds: np.ndarray, member: np.ndarray):
    """Start and end of every word; a word never crosses a document bound."""
    inside = member[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = bounds[(bounds > 0) & (bounds < len(buf))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``buf[start:end]``."""
    pw, inv = powers(len(buf))
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE[buf] * pw[:-1], out=c[1:])
    return mix((c[ends] - c[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def groups(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``PIECE`` bytes together, or one longer document."""
    i, d = 0, len(bounds) - 1
    while i < d:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE, "right")) - 1)
        yield i, min(j, d)
        i = min(j, d)


def scan_words(buf: np.ndarray, bounds: np.ndarray, member: np.ndarray, lower: bool
               ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of documents: first and last document number, word hashes, the places where
    each document's words begin in them (one more than documents), word starts and ends."""
    for i, j in groups(bounds):
        lo, hi = bounds[i], bounds[j]
        if hi - lo <= PIECE:
            part = LOWER[buf[lo:hi]] if lower else buf[lo:hi]
            own = bounds[i:j + 1] - lo
            starts, ends = find_words(part, own, member)
            yield (i, j, hash_words(part, starts, ends), np.searchsorted(starts, own),
                   starts + lo, ends + lo)
        else:                                   # one long document, cut where no word is cut
            none = np.empty(0, np.int64)
            found = [(none.astype(np.uint64), none, none)]
            for at, starts, ends, h in long_words(buf[lo:hi], member, lower):
                found.append((h, starts + (at + lo), ends + (at + lo)))
            h, starts, ends = (np.concatenate(x) for x in zip(*found))
            yield i, j, h, np.array([0, len(h)]), starts, ends


def long_words(buf: np.ndarray, member: np.ndarray, lower: bool):
    """Pieces of one long document: offset, word starts, word ends, word hashes."""
    at = 0
    while at < len(buf):
        end = min(at + PIECE, len(buf))
        while end < len(buf):
            part = LOWER[buf[at:end]] if lower else buf[at:end]
            gap = np.flatnonzero(~member[part])
            if len(gap):
                end = at + int(gap[-1]) + 1
                break
            end = min(end + PIECE, len(buf))
        part = LOWER[buf[at:end]] if lower else buf[at:end]
        starts, ends = find_words(part, np.array([0, len(part)]), member)
        yield at, starts, ends, hash_words(part, starts, ends)
        at = end


def word_numbers(column: pa.Array, spelling: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts, the number of every word (from 0), and where each text's words begin.

    ``spelling``: what each byte is read as; what becomes white space ends words."""
    buf, bounds = buffers(column)
    return split_words(buf if spelling is None else spelling[buf], bounds)


def split_words(buf: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The same for texts that lie end to end in a buffer."""
    texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(buf))
    lists = pc.ascii_split_whitespace(texts)
    words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    full = pc.greater(pc.binary_length(words), 0)       # a text that begins or ends with space has an empty one
    real = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    coded = words.filter(full).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), real[ends]


def segment_ids(offsets: np.ndarray) -> np.ndarray:
    """The document number of every element, from the places where documents begin."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def whole_windows(offsets: np.ndarray, n: int) -> np.ndarray:
    """For every window of ``n`` words of a run of documents: does it stay in one document?"""
    total = max(0, int(offsets[-1]) - n + 1)
    ok = np.ones(total, bool)
    for cut in offsets[1:-1]:
        ok[max(0, cut - n + 1):cut] = False
    return ok


def listed(offsets: np.ndarray, values: np.ndarray, kind=None) -> pa.ListArray:
    """An Arrow list column from places and flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
