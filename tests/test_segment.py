"""The unigram segmenter against segmentations written out one by one."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, needs
from corpusforge.operators import segment as U
from corpusforge.operators import tokens as W

PHRASES = ["ho chi minh city", "new york", "new york city", "uy ban nhan dan", "a", "b", "c", "d , e", "chi minh", "the", "the city", "odd"]


def _texts(seed=4, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(PHRASES) for _ in range(rng.randint(0, 9))) for _ in range(n)] + ["", "one", ", ,", None, "x" * 3000]


def _ways(words, prob, rare, k):
    """All segmentations of a run: (log-probability, pieces)."""
    if not words:
        return [(0.0, ())]
    out = []
    for n in range(1, min(k, len(words)) + 1):
        piece = " ".join(words[:n])
        if piece in prob or n == 1:
            lp = prob.get(piece, rare)
            out += [(lp + rest, ((piece,) + pieces)) for rest, pieces in _ways(words[n:], prob, rare, k)]
    return out


def _brute_runs(texts):
    runs = Counter()
    for t in texts:
        run = []
        for w in (t or "").split() + [","]:
            if w == ",":
                if run:
                    runs[" ".join(run)] += 1
                run = []
            else:
                run.append(w)
    return runs


def _brute(texts, compounds, rounds, min_count, k):
    """Expectation maximisation over written-out segmentations; the probabilities and the likelihoods before each round."""
    runs = _brute_runs(texts)
    words = Counter()
    for r, n in runs.items():
        for w in r.split():
            words[w] += n
    counts = {None: sum(n for n in words.values() if n < min_count)}
    counts |= {w: n for w, n in words.items() if n >= min_count} | compounds
    fits = []
    for step in range(rounds + 1):
        total = sum(n + U.SMOOTH for n in counts.values())
        lp = {p: math.log((n + U.SMOOTH) / total) for p, n in counts.items()}
        if step == rounds:
            return lp, fits
        counts, fit = dict.fromkeys(lp, 0.0), 0.0
        for r, n in runs.items():
            ways = _ways(r.split(), lp, lp[None], k)
            whole = math.log(sum(math.exp(x) for x, _ in ways))
            fit += n * whole
            for x, pieces in ways:
                for p in pieces:
                    counts[p if p in lp else None] += n * math.exp(x - whole)
        fits.append(fit)


@pytest.mark.parametrize("max_pieces", [U.MAX_PIECES, 0])  # probabilities with every task, and as a table
def test_model_and_segmentation_against_all_segmentations(spark, max_pieces):
    texts = [t if t is None or len(t.split()) < 13 else " ".join(t.split()[:12]) for t in _texts()]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    lex = W.compound_lexicon(df, min_count=2, pmi_ratio=2)
    compounds = {r.compound: r.n for r in lex.collect()}
    assert any(c.count(" ") == 2 for c in compounds)
    model, fits = U.learn(df, compounds=lex, rounds=3, min_count=2, max_pieces=max_pieces)
    want, want_fits = _brute(texts, compounds, 3, 2, W.MAX_WORDS)
    got = {r.text: r.lp for r in model.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[p], want[p], rel_tol=1e-9, abs_tol=1e-9) for p in want)
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(fits, want_fits, strict=True)) and fits == sorted(fits)
    out = {r.k: r.text for r in U.segment(df, model, "k", max_pieces=max_pieces).collect()}
    merged = 0
    for key, text in enumerate(texts):
        tokens = out[key].split()
        assert " ".join(out[key].replace("_", " ").split()) == " ".join((text or "").split())  # the same words in the same order
        run = []
        for w in tokens + [","]:
            if w != ",":
                run.append(w.replace("_", " "))
                continue
            ways = _ways(" ".join(run).split(), want, want[None], W.MAX_WORDS)
            mine = sum(want.get(p, want[None]) for p in run)
            assert math.isclose(mine, max(x for x, _ in ways), rel_tol=1e-9, abs_tol=1e-9)
            run = []
        merged += "_" in out[key]
    assert merged > 10


def test_awkward_inputs(spark):
    empty = spark.createDataFrame([], "k long, text string, words string")
    model, fits = U.learn(empty)
    assert [r.text for r in model.collect()] == [None] and fits == [0.0] * U.ROUNDS
    long = " ".join(["new york"] * 20_000)
    rows = [(1, "new york new york", "x"), (1, "new york new york", "x"), (None, None, None), (2, "", ""), (3, long, "y"), (4, "unseen, words", "z")]
    df = spark.createDataFrame(rows, "k long, text string, words string")
    lex = spark.createDataFrame([("new york", 20_002)], "compound string, n long")
    model, _ = U.learn(df, compounds=lex, rounds=2)
    out = sorted((str(r.k), r.text) for r in U.segment(df, model, "k").collect())
    assert out[0] == out[1] == ("1", "new_york new_york") and out[2] == ("2", "") and out[5] == ("None", "")
    assert out[3] == ("3", " ".join(["new_york"] * 20_000)) and out[4] == ("4", "unseen , words")


@needs(SF_SMALL)
def test_held_out_likelihood_above_merged_pairs(spark):
    """Texts outside the training set are likelier than as words, and as pairs merged from left to right."""
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").dropDuplicates(["text"])
    seen, held = d.filter("doc_id % 4 <> 0"), d.filter("doc_id % 4 = 0")
    lex = W.compound_lexicon(seen)
    learnt, fits = U.learn(seen, compounds=lex)
    assert fits[-1] > fits[0]
    words, _ = U.learn(seen, compounds=lex.limit(0), rounds=1)
    got, plain = U.log_likelihood(held, learnt), U.log_likelihood(held, words)
    pairs = W.bigram_lexicon(seen)
    probs = _pair_model(seen, pairs)
    merged = sum(probs.get(p, probs[None]) for t in _pieces(held, pairs) for p in t)
    assert got > merged and got > plain, (got, merged, plain)


def _pieces(texts, pairs):
    rows = W.merge_compounds(texts, pairs, "doc_id").select(F.split("text", " ").alias("t")).collect()
    return [[w for w in r.t if w and (w[0].isalnum() or w[0] == "_")] for r in rows]


def _pair_model(texts, pairs):
    """Log-probabilities of W2's pieces, those seen fewer than MIN_COUNT times sharing one."""
    n = Counter(p for t in _pieces(texts, pairs) for p in t)
    counts = {p: c for p, c in n.items() if c >= W.MIN_COUNT}
    counts[None] = sum(c for c in n.values() if c < W.MIN_COUNT)
    total = sum(c + U.SMOOTH for c in counts.values())
    return {p: math.log((c + U.SMOOTH) / total) for p, c in counts.items()}


def test_runs_test_no_token_by_itself(spark, monkeypatch):
    """Runs are the words between punctuation, whatever white space is between them."""
    plans = []
    monkeypatch.setattr(U, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString().lower()) or df)
    df = spark.createDataFrame([("a　b\x1cc  d, a b",), ("(a b) 1.000",), (None,), (", .",)], "text string")
    assert sorted((r.words, r.n, r.len) for r in U.word_runs(df).collect()) == [("1.000", 1, 1), ("a b", 2, 2), ("a b c d", 1, 4)]
    assert "rlike" not in plans[0]
