"""word groups held as hashes, the lexicon and the segmenter over them, and what they leave written."""

import os
import pickle
import random

import numpy as np
import pyarrow as pa

from corpusforge.functions.held import Held, Words, gathered
from corpusforge.operators import segment as U
from corpusforge.operators import tokens as W


def _held(texts):
    return Held(*Words(pa.array(texts, pa.string())).whole(), np.arange(len(texts)))


def test_groups_against_a_dictionary():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b c ü 漢 ab".split()) for _ in range(rng.randint(1, 9))) for _ in range(300)] + ["a"]
    pieces = sorted({" ".join(t.split()[i:i + k]) for t in texts[:60] for i in range(len(t.split())) for k in (1, 2, 3, 5) if i + k <= len(t.split())})
    held, words = _held(pieces), Words(pa.array(texts))
    got = held.groups(words, 4)
    at = 0
    for t in texts:
        w = t.split()
        for i in range(len(w)):
            want = [pieces.index(g) if i + k <= len(w) and (g := " ".join(w[i:i + k])) in pieces else -1 for k in range(1, 5)]
            assert got[at].tolist() == want
            at += 1
    assert at == len(got) and (held.groups(words, 4, 3)[:, :2] == -1).all() and (held.groups(words, 4, 3)[:, 2:] == got[:, 2:]).all()
    none = _held([])
    assert len(none) == 0 and (none.groups(words, 2) == -1).all() and held.groups(Words(pa.array([], pa.string())), 2).shape == (0, 2)


def test_groups_that_share_a_lane():
    first, second = np.array([7, 7, 7, 9], np.uint64), np.array([3, 1, 2, 1], np.uint64)
    held = Held(first, second, np.arange(4))
    assert held.find(np.array([7, 9, 7, 7, 7, 8], np.uint64), np.array([1, 1, 2, 3, 4, 1], np.uint64)).tolist() == [1, 3, 2, 0, -1, -1]


def test_a_held_text_takes_few_bytes():
    """What goes to every task does not grow with the length of the texts."""
    held = _held([f"a rather long compound of number {k}" for k in range(10_000)])
    held.find(held.first, held.second)
    held.maybe = None
    assert len(pickle.dumps(held)) < 25 * 10_000


def test_batches_are_put_together():
    batches = [pa.RecordBatch.from_arrays([pa.array([f"{k} {i}" for i in range(10)])], ["t"]) for k in range(7)]
    got = list(gathered(iter(batches), 300))
    assert 1 < len(got) < 7 and [x for b in got for x in b["t"].to_pylist()] == [x for b in batches for x in b["t"].to_pylist()]


def _written(spark):
    return {x for x in os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))}


def test_only_the_model_stays_written(spark):
    """Runs, pairs, lattices and rounds are deleted once read; only pairs of words that are seen often are counted."""
    rare = [f"new york n{i} r{i} new york " + " ".join(f"x{i}x{j}" for j in range(20)) for i in range(40)]
    df = spark.createDataFrame(list(enumerate([*rare, "old town, old town", None, ""])), "k long, text string")
    runs = W.materialize(W.run_counts(df), "test-runs")
    counts = W._held_pairs(runs, W.numbered(W.word_counts(runs).filter("n >= 5")))[0]
    assert [r.n for r in counts.collect()] == [80]
    before = _written(spark)
    model, _ = U.learn(df, rounds=1)
    assert [x.rsplit("-", 1)[0] for x in _written(spark) - before] == ["model"]
    assert sorted(r.text or "" for r in model.collect()) == ["", "new", "new york", "york"]
    assert U.segment(df, model, "k").filter("k = 3").first().text.startswith("new_york n3 r3 new_york x3x0 ")


def test_what_was_not_written_here_is_not_deleted(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(3).write.parquet(path)
    W.discard(spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 3
