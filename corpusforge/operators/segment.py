"""A unigram word segmenter (W1) learnt from the corpus itself.

Pieces are single words and the compounds of the lexicon (W2).  A run of words
between punctuation is a sequence of pieces drawn independently, so it has
many segmentations; expectation maximisation learns the pieces' probabilities
over all of them, and a text's most probable segmentation is its tokens.
Unlike merging from left to right, whether ``a b`` is one piece depends on
what the words around it would lose.

Work is done per distinct run, with its number of copies, so a passage that
fills a third of the corpus is one row.  Each round is a narrow pass over the
written runs and one aggregate by piece, combined in the tasks first.  Words
seen fewer than ``min_count`` times share one piece, the rare one.

Null and empty texts have no runs and come back as the empty text; an empty
corpus gives a model of the rare piece alone.  A run is held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import lattice
from corpusforge.functions import tokens as TK
from corpusforge.functions.held import Held, Words, gathered
from corpusforge.operators import tokens as W
from corpusforge.operators.plan_utils import discard, explode_computed, materialize

RARE = 0  # the piece of all words that are too rare to have their own
RUN = -1  # stands for a piece in the row of a round's log-likelihood
ROUNDS = 4
SMOOTH = 1e-3  # added to every expected count, so that no word becomes impossible
MAX_PIECES = W.MAX_HELD  # pieces that are sent to every task, as hashes, at most
GAP = "\n"  # between runs; no token holds white space

_LATTICE = "run long, n long, len int, slots array<int>, pieces array<int>"


def word_runs(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``run, words, n, len``: the distinct runs of words between punctuation, how often each is seen, its words."""
    runs = W.run_counts(texts, text_col)
    return materialize(runs.select(F.monotonically_increasing_id().alias("run"), "words", "n", F.size(F.split("words", " ")).alias("len")), "runs")


def piece_counts(words: DataFrame, compounds: DataFrame, min_count: int = W.MIN_COUNT) -> DataFrame:
    """``piece, text, n``: numbered pieces with how often each is seen, overlaps counted; piece 0 holds all rare ``words`` (``text, n``)."""
    own = W.numbered(words.filter(F.col("n") >= min_count).unionByName(compounds.select(F.col("compound").alias("text"), "n")))
    rare = words.filter(F.col("n") < min_count).agg(F.lit(RARE).alias("piece"), F.lit(None).cast("string").alias("text"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    out = materialize(rare.unionByName(own), "pieces")
    discard(own)
    return out


def _list(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def _edges(runs: pa.Array, pieces: Held, max_words: int) -> list[pa.Array]:
    """The ``len, slots, pieces`` of runs."""
    words = Words(runs)
    numbers = pieces.groups(words, max_words)
    held = numbers.ravel() >= 0
    at = np.flatnonzero(held)
    start = np.repeat(words.bounds[:-1], words.lengths)[at // max_words]
    bounds = np.searchsorted(at, words.bounds * max_words)
    return [pa.array(words.lengths, pa.int32()), _list(at - start * max_words, bounds), _list(numbers.ravel()[at], bounds)]


def lattices(runs: DataFrame, pieces: DataFrame, max_words: int = W.MAX_WORDS, max_pieces: int = MAX_PIECES) -> DataFrame:
    """``run, n, len, slots, pieces``: which pieces lie where; the piece of k words at word i (from 0) has slot ``i * max_words + k - 1``.

    Up to ``max_pieces`` pieces go to every task and runs stay where they are; more stay a table that all words and word groups meet.
    """
    if pieces.count() <= max_pieces:
        held = runs.sparkSession.sparkContext.broadcast(W.held(pieces))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches):
                yield pa.RecordBatch.from_arrays([batch["run"], batch["n"], *_edges(batch["words"], held.value, max_words)],
                                                 ["run", "n", "len", "slots", "pieces"])

        return materialize(runs.select("run", "n", "words").mapInArrow(look_up, _LATTICE), "lattices")
    grams = F.expr(f"""flatten(transform(sequence(0, size(w) - 1), i -> transform(sequence(1, least({max_words}, size(w) - i)),
        k -> struct(i * {max_words} + k - 1 AS slot, array_join(slice(w, i + 1, k), ' ') AS text))))""")
    at = explode_computed(runs.select("run", F.split("words", " ").alias("w")), grams, ["run"], None, "g")
    at = at.select("run", "g.slot", "g.text").join(pieces.filter("text IS NOT NULL").select("text", "piece"), "text")
    held = at.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("slot", "piece"))).alias("e"))
    return materialize(runs.join(held, "run", "left").select("run", "n", "len", F.coalesce("e.slot", F.array().cast("array<int>")).alias("slots"),
                                                             F.coalesce("e.piece", F.array().cast("array<int>")).alias("pieces")), "lattices")


def _probabilities(counts: DataFrame) -> DataFrame:
    """``piece, lp``: log-probabilities from (expected) counts; written once, as every round reads them twice."""
    total = counts.agg(F.sum(F.col("n") + F.lit(SMOOTH))).scalar()
    return materialize(counts.select("piece", F.log((F.col("n") + F.lit(SMOOTH)) / total).alias("lp")), "probabilities")


def _lists(col) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow list column as its values and the rows' bounds in them."""
    bounds = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _stacked(batch: pa.RecordBatch, max_words: int, model: np.ndarray | None = None) -> Iterator[tuple]:
    """Stacks of a batch's runs: their row numbers, lengths, the pieces (-1: none) and log-probabilities of their edges (from ``model``, by piece, or the batch)."""
    lengths = batch["len"].to_numpy()
    (slots, bounds), (ids, _) = _lists(batch["slots"]), _lists(batch["pieces"])
    if model is None:
        lps, rare = _lists(batch["lps"])[0], batch["rare"].to_numpy()
    else:
        lps, rare = model[ids], np.full(len(lengths), model[RARE])
    for rows in lattice.stacks(lengths):
        n = lengths[rows]
        shape = (len(rows), int(n[0]), max_words)
        piece = np.full(shape, -1, np.int32)
        lp = np.full(shape, -np.inf)
        inside = np.arange(shape[1]) < n[:, None]
        piece[:, :, 0][inside] = RARE
        lp[:, :, 0] = np.where(inside, rare[rows][:, None], -np.inf)
        edges = bounds[rows + 1] - bounds[rows]
        before = np.cumsum(edges) - edges
        at = np.arange(edges.sum()) + np.repeat(bounds[rows] - before, edges)
        cell = slots[at] + np.repeat(np.arange(len(rows)) * (shape[1] * max_words), edges)
        piece.reshape(-1)[cell] = ids[at]
        lp.reshape(-1)[cell] = lps[at]
        yield rows, n, piece, lp


def _by_piece(model: DataFrame) -> np.ndarray:
    """Log-probabilities by piece number, on the driver: for at most ``max_pieces`` pieces, as the callers check."""
    rows = model.select("piece", "lp").toArrow()
    lp = np.full(rows.num_rows, -np.inf)
    lp[rows["piece"].to_numpy()] = rows["lp"].to_numpy()
    return lp


def _with_probabilities(lat: DataFrame, model: DataFrame) -> DataFrame:
    """``lat`` with the log-probabilities ``lps`` of its ``pieces``, and that of the ``rare`` piece, from a model that is too large to be held."""
    rare = model.filter(F.col("piece") == RARE).select("lp").scalar()
    lat = lat.withColumn("rare", rare)
    edges = explode_computed(lat, F.col("pieces"), ["run"], "at", "piece").join(model, "piece")
    lps = edges.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("at", "lp"))).alias("e"))
    return lat.join(lps, "run", "left").withColumn("lps", F.coalesce("e.lp", F.array().cast("array<double>"))).drop("e")


def expected_counts(lat: DataFrame, model: DataFrame, max_words: int = W.MAX_WORDS, max_pieces: int = MAX_PIECES) -> DataFrame:
    """One E step: ``piece, n``, how often each piece is expected in the corpus; piece -1 has the corpus' log-likelihood.

    Up to ``max_pieces`` pieces go to every task as one array of doubles; more stay a table that the edges meet.
    """
    if model.count() <= max_pieces:
        known = lat.sparkSession.sparkContext.broadcast(_by_piece(model))
        rows = lat.select("n", "len", "slots", "pieces")
    else:
        known = None
        rows = _with_probabilities(lat, model).select("n", "len", "slots", "pieces", "rare", "lps")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # as they come: sums in another order differ in their last bits, which decide between segmentations that are equally likely
            times = batch["n"].to_numpy()
            for rows, n, piece, lp in _stacked(batch, max_words, known and known.value):
                share, whole = lattice.posterior(lp, n)
                share *= times[rows][:, None, None]
                used = piece >= 0
                ids, at = np.unique(piece[used], return_inverse=True)
                sums = np.bincount(at, share[used], len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(ids, RUN).astype(np.int32)), pa.array(np.append(sums, whole @ times[rows]))], ["piece", "n"])

    return rows.mapInArrow(step, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))


def learn(texts: DataFrame, text_col: str = "text", compounds: DataFrame | None = None, rounds: int = ROUNDS, min_count: int = W.MIN_COUNT,
          max_words: int = W.MAX_WORDS, max_pieces: int = MAX_PIECES) -> tuple[DataFrame, list[float]]:
    """The model ``piece, text, lp`` after ``rounds`` rounds, and the corpus' log-likelihood before each of them.

    ``compounds`` (``compound, n``) are the pieces of several words, by default the lexicon of the texts.
    """
    runs = word_runs(texts, text_col)
    words = W.word_counts(runs)
    own = W.lexicon_of_runs(runs, words, max_words, min_count) if compounds is None else None
    pieces = piece_counts(words, compounds if own is None else own, min_count)
    discard(words, *[own] * (own is not None))
    lat, model, fits = lattices(runs, pieces, max_words, max_pieces), _probabilities(pieces), []
    discard(runs)
    for _ in range(rounds):
        counts = materialize(expected_counts(lat, model, max_words, max_pieces), "expected")
        fits += [r.n for r in counts.filter(F.col("piece") == RUN).collect()] or [0.0]
        all_pieces = pieces.select("piece").join(counts, "piece", "left").select("piece", F.coalesce("n", F.lit(0.0)).alias("n"))
        before, model = model, _probabilities(all_pieces)
        discard(counts, before)
    out = materialize(model.join(pieces.select("piece", "text"), "piece").select("piece", "text", "lp"), "model")
    discard(lat, pieces, model)
    return out, fits


def log_likelihood(texts: DataFrame, model: DataFrame, text_col: str = "text", max_words: int = W.MAX_WORDS, max_pieces: int = MAX_PIECES) -> float:
    """The log-probability of texts that the model need not have seen, over all their segmentations."""
    lat = lattices(word_runs(texts, text_col), model, max_words, max_pieces)
    found = expected_counts(lat, model.select("piece", "lp"), max_words, max_pieces).filter(F.col("piece") == RUN).collect()
    return found[0].n if found else 0.0


def _glued_runs(batch: pa.RecordBatch, max_words: int, model: np.ndarray | None = None) -> dict[str, str]:
    """A batch's runs whose most probable segmentation holds a compound, with the words of each joined by ``_``."""
    out = {}
    for rows, n, _, lp in _stacked(batch, max_words, model):
        goes_on = lattice.best(lp, n)
        some = np.flatnonzero(goes_on.any(1))
        for run, marks in zip(batch["words"].take(pa.array(rows[some])).to_pylist(), goes_on[some], strict=True):
            w = run.split(" ")
            out[run] = w[0] + "".join(("_" if on else " ") + x for x, on in zip(w[1:], marks[1:].tolist()))
    return out


def segment(texts: DataFrame, model: DataFrame, key: str, text_col: str = "text", max_words: int = W.MAX_WORDS, max_pieces: int = MAX_PIECES) -> DataFrame:
    """``key`` and each text as its tokens joined by spaces, the words of a piece by ``_``: its most probable segmentation.

    Up to ``max_pieces`` pieces go to every task, and texts are segmented where they lie.  With more, every distinct
    run is segmented once, and runs that hold a compound go back to the texts, by row number.
    """
    mark = F.array_join(TK.runs_and_others(text_col), GAP)
    if model.count() <= max_pieces:
        known = texts.sparkSession.sparkContext.broadcast((W.held(model), _by_piece(model)))

        @F.arrow_udf("string")
        def segmented(marked: pa.Array) -> pa.Array:
            pieces, lp = known.value
            parts = [t.split(GAP) if t else [] for t in marked.to_pylist()]
            runs = pa.array(list(dict.fromkeys(p for t in parts for p in t)), pa.string())
            batch = pa.RecordBatch.from_arrays([runs, *_edges(runs, pieces, max_words)], ["words", "len", "slots", "pieces"])
            glued = _glued_runs(batch, max_words, lp)
            return pa.array([" ".join(glued.get(p, p) for p in t) for t in parts], pa.string())

        return texts.select(key, segmented(mark).alias(text_col))
    rows = materialize(texts.select(key, F.monotonically_increasing_id().alias("_row"), F.array_join(TK.tokens(text_col), " ").alias("_t"), mark.alias("_m")), "tokens")
    runs = word_runs(rows, "_t")
    lat = _with_probabilities(lattices(runs, model, max_words, max_pieces), model.select("piece", "lp"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _glued_runs(batch, max_words)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.string())], ["words", "glued"])

    lat = lat.join(runs.select("run", "words"), "run").select("words", "len", "slots", "pieces", "rare", "lps")
    merged = materialize(lat.mapInArrow(decode, "words string, glued string"), "glued")  # runs without a compound stay as they are
    parts = F.split("_m", GAP)
    at = explode_computed(rows.filter("_t <> ''"), parts, ["_row"], "at", "words")
    hits = at.join(merged, "words").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct(F.col("at").cast("int"), "glued"))).alias("hits"))
    back = rows.join(hits, "_row", "left").withColumn("parts", parts)
    whole = F.array_join(F.transform("parts", lambda p, i: F.coalesce(F.try_element_at("hits", i + 1), p)), " ")
    return back.select(key, F.when(F.col("hits").isNull(), F.col("_t")).otherwise(whole).alias(text_col))
