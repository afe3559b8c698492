"""Words of a UTF-8 text as numpy arrays (shared by the hashing operators).

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``.
Hashes are polynomial over the bytes, modulo 2**64, taken from prefix sums:
the hash of any span costs two look-ups.  Texts are walked in fixed blocks, so
the memory beside the text itself is a few numbers per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
INVERSE = pow(BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True


def _powers(x: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * U64(pow(x, done, 1 << 64))
        done += step
    return out


POWERS = _powers(BASE, BLOCK)
INVERSES = _powers(INVERSE, BLOCK)
BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (murmur-style): spreads every input bit."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a whole string column, one text after the other, and where each starts (and the last ends); a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of every value; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1] if len(column) else []
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    for i in range(len(column)):
        yield raw[ends[i]:ends[i + 1]]


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    inside = np.zeros(len(b) + 2, np.int8)
    np.logical_not(IS_SPACE[b], out=inside[1:-1].view(bool))
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def prefixes(b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted byte positions ``at``: the hash sum and the code points before each."""
    hashes, points = np.zeros(len(at), U64), np.zeros(len(at), np.int64)
    total, count = 0, 0
    lo = int(np.searchsorted(at, 0, "right")) if len(at) else 0
    for start in range(0, len(b), BLOCK):
        part = b[start:start + BLOCK]
        scale = pow(BASE, start, 1 << 64)
        h = np.cumsum(BYTE_VALUE[part] * POWERS[:len(part)], dtype=U64)
        p = np.cumsum((part & 0xC0) != 0x80)
        hi = int(np.searchsorted(at, start + len(part), "right"))
        here = at[lo:hi] - start - 1
        hashes[lo:hi] = h[here] * U64(scale) + U64(total)
        points[lo:hi] = count + p[here]
        total, count, lo = (total + int(h[-1]) * scale) & MASK, count + int(p[-1]), hi
    return hashes, points


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and code points of each span; spans are sorted and do not overlap."""
    if not len(starts):
        return np.empty(0, U64), np.empty(0, np.int64)
    at = np.column_stack((starts, ends)).ravel()
    h, p = prefixes(b, at)
    back = INVERSES[starts % BLOCK]
    if starts[-1] >= BLOCK:
        back = back * _powers(pow(INVERSE, BLOCK, 1 << 64), int(starts[-1]) // BLOCK + 1)[starts // BLOCK]
    # the length joins the hash: equal sums of spans of different length differ
    return mix((h[1::2] - h[0::2]) * back + (ends - starts).astype(U64)), p[1::2] - p[0::2]


def grow(grams: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """From the hashes of all (n-1)-word windows, those of all n-word windows."""
    return mix(grams[:-1] * U64(BASE) + words[n - 1:])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows; a shorter text with words has one window."""
    if not len(words):
        return words
    grams = words
    for k in range(2, min(n, len(words)) + 1):
        grams = grow(grams, words, k)
    return grams
