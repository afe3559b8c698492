"""Segmentation lattices over runs of words, many at once in numpy.

A run of n words has an edge for every piece of 1 to K words that lies in it.
Runs of like length are stacked: ``lp[r, i, k]`` is the log-probability of the
piece of k + 1 words that starts at word i of run r (-inf where there is none).
All sums are of logarithms, so runs of any length neither vanish nor overflow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CELLS = 1 << 17  # run x word cells in a stack, unless one run alone has more


def stacks(lengths: np.ndarray, cells: int = CELLS) -> Iterator[np.ndarray]:
    """Row numbers of runs of like length, so that a stack has at most ``cells`` cells; empty runs are left out."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        rows = order[at:at + max(1, cells // int(lengths[order[at]]))]
        yield rows
        at += len(rows)


def forward(lp: np.ndarray) -> np.ndarray:
    """``a[r, j]``: log-probability of the first j words of run r, over all their segmentations."""
    runs, n, k = lp.shape
    a = np.full((runs, n + 1), -np.inf)
    a[:, 0] = 0.0
    for j in range(1, n + 1):
        steps = [a[:, j - 1 - w] + lp[:, j - 1 - w, w] for w in range(min(k, j))]
        a[:, j] = np.logaddexp.reduce(steps)
    return a


def backward(lp: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``b[r, i]``: log-probability of the words of run r from word i to its end."""
    runs, n, k = lp.shape
    b = np.full((runs, n + 1), -np.inf)
    b[np.arange(runs), lengths] = 0.0
    for i in range(n - 1, -1, -1):
        steps = [lp[:, i, w] + b[:, i + 1 + w] for w in range(min(k, n - i))]
        b[:, i] = np.where(i < lengths, np.logaddexp.reduce(steps), b[:, i])
    return b


def posterior(lp: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of every edge given its run, and the log-probability of every run."""
    a, b = forward(lp), backward(lp, lengths)
    whole = a[np.arange(len(a)), lengths]
    out = np.zeros_like(lp)
    n = lp.shape[1]
    for w in range(min(lp.shape[2], n)):
        out[:, :n - w, w] = np.exp(a[:, :n - w] + lp[:, :n - w, w] + b[:, 1 + w:] - whole[:, None])
    return out, whole


def best(lp: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``[r, i]``: whether word i of run r goes on with the piece of the word before it in the run's most probable segmentation; of equal ones, the longer last piece."""
    runs, n, k = lp.shape
    top = np.full((runs, n + 1), -np.inf)
    top[:, 0] = 0.0
    words = np.zeros((runs, n + 1), np.int64)
    for j in range(1, n + 1):
        steps = np.array([top[:, j - 1 - w] + lp[:, j - 1 - w, w] for w in range(min(k, j))])[::-1]
        at = steps.argmax(0)
        top[:, j] = steps[at, np.arange(runs)]
        words[:, j] = len(steps) - at
    goes_on = np.ones((runs, n), bool)
    rows, j = np.arange(runs), lengths.astype(np.int64)
    while len(rows):
        j = j - words[rows, j]
        goes_on[rows, j] = False  # a piece starts here
        rows, j = rows[j > 0], j[j > 0]
    return goes_on & (np.arange(n) < lengths[:, None])
