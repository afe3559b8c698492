"""Word groups held as 128-bit hashes and looked up many at once in numpy.

A group of words is the weighted sum of its words' hashes, in two lanes of 64
bits: 20 bytes a group however long its text is, so millions of them can go to
every task.  Groups of all lengths at all places of a batch are looked up
without building a string.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH = 1 << 22  # bytes of a batch that is looked up at once, unless one row alone has more


def _weights(n: int) -> np.ndarray:
    """The odd weights of a group's first, second, ... word."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))


def gathered(batches: Iterator[pa.RecordBatch], most: int = BATCH) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.nbytes
        if size >= most:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()
            some, size = [], 0
    if some:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()


class Words:
    """The words of texts that are joined by single spaces: ``values``, the texts' ``bounds`` in them, ``left``: words from
    each to its text's end, and the two lanes of their hashes."""

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.split_pattern(texts, " ")
        self.values, self.lengths = lists.flatten(), np.asarray(pc.list_value_length(lists), np.int64)
        self.bounds = np.r_[0, np.cumsum(self.lengths)]
        self.left = np.repeat(self.bounds[1:], self.lengths) - np.arange(len(self.values))
        words = self.values.dictionary_encode()
        raw = b"".join(blake2b(w, digest_size=16).digest() for w in words.dictionary.cast(pa.binary()).to_pylist())
        lanes = np.frombuffer(raw, np.uint64).reshape(-1, 2)[np.asarray(words.indices, np.int64)]
        self.first, self.second = lanes[:, 0].copy(), lanes[:, 1].copy()

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the texts as groups."""
        if not len(self.lengths):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        place = np.repeat(self.lengths, self.lengths) - self.left
        weight = _weights(int(self.lengths.max()))[place]
        return np.add.reduceat(self.first * weight, self.bounds[:-1]), np.add.reduceat(self.second * weight, self.bounds[:-1])


class Held:
    """Word groups with their numbers."""

    def __init__(self, first: np.ndarray, second: np.ndarray, numbers: np.ndarray) -> None:
        order = np.argsort(first)
        self.first, self.second, self.numbers = first[order], second[order], numbers[order].astype(np.int32)
        ends = np.flatnonzero(np.r_[self.first[1:] != self.first[:-1], np.ones(min(1, len(first)), bool)])
        self.most = int(np.diff(ends, prepend=-1).max(initial=0))  # groups that share the first lane: one, but for a chance
        self.shift = np.uint64(64 - max(10, (8 * len(first)).bit_length()))
        self.maybe = None

    def __len__(self) -> int:
        return len(self.first)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The numbers of groups, -1 for those not held."""
        if self.maybe is None:  # not until it is needed: it does not travel
            self.maybe = np.zeros(1 << (64 - int(self.shift)), bool)
            self.maybe[self.first >> self.shift] = True
        out = np.full(len(first), -1, np.int32)
        at = np.flatnonzero(self.maybe[first >> self.shift])
        a, b = first[at], second[at]
        place = np.searchsorted(self.first, a)
        for step in range(self.most):
            here = np.minimum(place + step, len(self) - 1)
            hit = (self.first[here] == a) & (self.second[here] == b)
            out[at[hit]] = self.numbers[here[hit]]
        return out

    def groups(self, words: Words, most: int, least: int = 1) -> np.ndarray:
        """``[i, k - 1]``: the number of the group of k words, from ``least`` to ``most``, that starts at word i and lies in its text; else -1."""
        out = np.full((len(words.values), most), -1, np.int32)
        a, b = np.zeros((2, len(words.values)), np.uint64)
        for k, weight in enumerate(_weights(most)):
            fits = np.flatnonzero(words.left > k)
            a[fits] += words.first[fits + k] * weight
            b[fits] += words.second[fits + k] * weight
            if k + 1 >= least:
                out[fits, k] = self.find(a[fits], b[fits])
        return out
