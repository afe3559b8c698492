"""Tokenised corpus (W1) and the distributed compound lexicon.

W2 replaces the pre-trained segmenter's compound detection with corpus
statistics: adjacent word pairs whose pointwise mutual information is high
are merged with ``_``.  Everything is a word-count style job: explode,
partial-aggregate, join the (distinct-keyed) unigram table twice, filter.
The PMI test is done in exact integer arithmetic (decimal(38,0)), so no
floating-point rounding decides membership.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import tokens as TK
from corpusforge.functions.held import Held, Words, gathered
from corpusforge.operators.plan_utils import discard, explode_computed, materialize, pinned, with_pinned

TOKENISED_COLUMNS = {"title": "tokenized_title", "summary": "tokenized_summary", "content": "tokenized_content"}

# Fixed defaults of the lexicon rule: keep a pair seen at least MIN_COUNT times
# whose co-occurrence is at least PMI_RATIO times chance (PMI >= log2(8) = 3 bits).
MARK = "\n"  # between two tokens of a lexicon pair; no token holds white space
MIN_COUNT = 5
PMI_RATIO = 8
MAX_WORDS = 4  # in a compound
MAX_PAIRS = 200_000  # lexicon pairs that are sent to every task as texts, at most
MAX_HELD = 4_000_000  # word groups that are sent to every task as hashes, at most (80 MB, and 64 MB more when they are looked up)


def tokenize_columns(df: DataFrame, columns=TOKENISED_COLUMNS, tokenizer=None) -> DataFrame:
    """Add ``tokenized_*`` columns for every present source column."""
    present = {src: dst for src, dst in columns.items() if src in df.columns}
    return df.withColumns({dst: TK.tokenize(src, tokenizer) for src, dst in present.items()})


def _with_next(t: Column) -> Column:
    """Each element of an array with its right neighbour (null at the end): ``w, w_next``."""
    nxt = F.concat(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    return F.arrays_zip(t.alias("w"), nxt.alias("w_next"))


def _words_of(t: Column) -> Column:
    """A token array with null in place of punctuation: the tokenizer gives
    either a word or a single other character, so the first character tells."""
    return F.transform(t, lambda x: F.when(F.substring(x, 1, 1).rlike(TK.W), x))


def pair_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``w, w_next, n`` for every word token ``w`` and its right neighbour.

    ``w_next`` is null at the end of a text or when the neighbour is not a
    word token, so every word token is counted exactly once: unigram counts
    are sums over this table (no second pass over the tokens).  Runs of words
    are matched whole, so no token is tested by itself; one explode, one
    partial aggregate.
    """
    r = explode_computed(texts, TK.runs(text_col), [], None, "_r")
    w = with_pinned(r, {"_w": F.split(TK.spaced("_r"), " ")})
    p = explode_computed(w, _with_next(pinned(F.col("_w"))), [], "i", "p")
    p = p.select(F.col("p.w").alias("w"), F.col("p.w_next").alias("w_next"))
    return p.groupBy("w", "w_next").agg(F.count(F.lit(1)).alias("n"))


def bigram_lexicon(texts: DataFrame, text_col: str = "text", min_count: int = MIN_COUNT,
                   pmi_ratio: int = PMI_RATIO) -> DataFrame:
    """``w1, w2, n12, n1, n2`` for pairs with ``n12 >= min_count`` and
    ``n12 * N >= pmi_ratio * n1 * n2`` (N = word tokens in the corpus).

    The pair table (one tokenisation pass) feeds the pair side and the word
    table, which both joins and the corpus total read; each is written once
    under the shared checkpoint folder.  Pairs are pruned by ``min_count``
    before the joins."""
    pairs = materialize(pair_counts(texts, text_col), "pairs")
    uni = materialize(pairs.groupBy("w").agg(F.sum("n").alias("n")), "words")
    total = uni.agg(F.sum("n")).scalar()  # scalar subquery: the corpus word-token count
    bi = pairs.filter(F.col("w_next").isNotNull() & (F.col("n") >= min_count)).select(
        F.col("w").alias("w1"), F.col("w_next").alias("w2"), F.col("n").alias("n12")
    )
    u1 = uni.select(F.col("w").alias("w1"), F.col("n").alias("n1"))
    u2 = uni.select(F.col("w").alias("w2"), F.col("n").alias("n2"))
    j = bi.join(u1, "w1").join(u2, "w2")
    dec = "decimal(38,0)"
    keep = (F.col("n12").cast(dec) * total.cast(dec)) >= (
        F.lit(pmi_ratio).cast(dec) * F.col("n1").cast(dec) * F.col("n2").cast(dec)
    )
    return j.filter(keep).select("w1", "w2", "n12", "n1", "n2")


def run_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``words, n``: the distinct runs of words between punctuation, joined by single spaces, and how often each is seen."""
    runs = explode_computed(texts, TK.runs(text_col), [], None, "_r").select(TK.spaced("_r").alias("words"))
    return runs.groupBy("words").agg(F.count(F.lit(1)).alias("n"))


def word_counts(runs: DataFrame) -> DataFrame:
    """``text, n``: the words of ``words, n``, written."""
    words = explode_computed(runs, F.split("words", " "), ["n"], None, "text").groupBy("text").agg(F.sum("n").alias("n"))
    return materialize(words, "words")


def numbered(texts: DataFrame) -> DataFrame:
    """``piece, text, n`` from ``text, n``: dense numbers from 1, by text; they come from counts per hash bucket, not from one sorted task."""
    own = materialize(texts.withColumn("bucket", F.pmod(F.xxhash64("text"), F.lit(1024))), "bucketed")
    sizes = {r.bucket: r.m for r in own.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).collect()}  # at most 1,024 rows
    first, at = [], 1
    for b in range(1024):
        first.append(at)
        at += sizes.get(b, 0)
    in_bucket = F.expr("row_number() OVER (PARTITION BY bucket ORDER BY text)")
    start = F.get(F.array(*[F.lit(x).cast("long") for x in first]), F.col("bucket").cast("int"))
    out = materialize(own.select((start + in_bucket - 1).cast("int").alias("piece"), "text", "n"), "numbered")
    discard(own)
    return out


def held(pieces: DataFrame) -> Held:
    """``piece, text`` as hashes, on the driver: for at most ``MAX_HELD`` texts, as the callers check."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lanes = Words(batch["text"]).whole()
            yield pa.RecordBatch.from_arrays([batch["piece"], *(pa.array(x.view(np.int64)) for x in lanes)], ["piece", "a", "b"])

    rows = pieces.filter("text IS NOT NULL").select("piece", "text").mapInArrow(hashed, "piece int, a long, b long").toArrow()
    return Held(rows["a"].to_numpy().view(np.uint64), rows["b"].to_numpy().view(np.uint64), rows["piece"].to_numpy())


def _held_pairs(runs: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``_a, _b, n``: the pairs of neighbours that are both among ``words`` (``piece, text, n``), by number; and what the numbers stand for, with the words' counts."""
    known = runs.sparkSession.sparkContext.broadcast(held(words))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            w = Words(batch["words"])
            ids = known.value.groups(w, 1)[:, 0].astype(np.int64)
            at = np.flatnonzero(w.left > 1)
            at = at[(ids[at] >= 0) & (ids[at + 1] >= 0)]
            keys, rows = np.unique(ids[at] << 32 | ids[at + 1], return_inverse=True)
            times = np.repeat(batch["n"].to_numpy(), w.lengths)[at]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.bincount(rows, times, len(keys)).astype(np.int64))], ["pair", "n"])

    counts = runs.select("words", "n").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.select(F.shiftright("pair", 32).cast("int").alias("_a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("_b"), "n")
    a = words.select(F.col("piece").alias("_a"), F.col("text").alias("head"), F.col("n").alias("_nh"))
    b = words.select(F.col("piece").alias("_b"), F.col("text").alias("last"), F.col("n").alias("_nw"))
    return counts, a, b


def _chains(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``words, n``: the longest stretches of at least three words in runs (``words, n``) in which every two neighbours are one of ``pairs`` (``compound``)."""
    known = runs.sparkSession.sparkContext.broadcast(held(pairs.select(F.lit(0).alias("piece"), F.col("compound").alias("text"))))

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            w = Words(batch["words"])
            linked = np.r_[False, known.value.groups(w, 2, 2)[:, 1] >= 0, False]
            first, last = np.flatnonzero(linked[1:] & ~linked[:-1]), np.flatnonzero(linked[:-1] & ~linked[1:])  # the stretch's words, both included
            long = last - first > 1
            first, last = first[long], last[long]
            found = [" ".join(w.values.slice(a, b - a + 1).to_pylist()) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(np.repeat(batch["n"].to_numpy(), w.lengths)[first])], ["words", "n"])

    return runs.select("words", "n").mapInArrow(stretches, "words string, n long")


def _held_groups(runs: DataFrame, below: DataFrame, k: int) -> DataFrame:
    """``head, last, n``: the groups of k words in runs whose first and last k - 1 words are both among ``below`` (``compound``)."""
    known = runs.sparkSession.sparkContext.broadcast(held(below.select(F.lit(0).alias("piece"), F.col("compound").alias("text"))))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            w = Words(batch["words"])
            part = known.value.groups(w, k - 1, k - 1)[:, k - 2] >= 0
            at = np.flatnonzero(w.left >= k)
            at = at[part[at] & part[at + 1]]
            words = w.values.to_pylist()
            head = [" ".join(words[i:i + k - 1]) for i in at.tolist()]
            last = [words[i + k - 1] for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(head, pa.string()), pa.array(last, pa.string()), pa.array(np.repeat(batch["n"].to_numpy(), w.lengths)[at])],
                                             ["head", "last", "n"])

    return runs.select("words", "n").mapInArrow(groups, "head string, last string, n long").groupBy("head", "last").agg(F.sum("n").alias("n"))


def _joined_groups(runs: DataFrame, below: DataFrame, k: int) -> DataFrame:
    """:func:`_held_groups` by joins, for a level that is too large to be held."""
    words = F.split("words", " ")
    rows = runs.filter(F.size(words) >= k).select("n", words.alias("_w"))
    rows = explode_computed(rows, F.expr(f"transform(sequence(1, size(_w) - {k - 1}), i -> slice(_w, i, {k}))"), ["n"], None, "x")
    rows = rows.select("n", F.concat_ws(" ", F.slice("x", 1, k - 1)).alias("head"), F.concat_ws(" ", F.slice("x", 2, k - 1)).alias("tail"), F.get("x", F.lit(k - 1)).alias("last"))
    part = below.select(F.col("compound").alias("_c"))
    both = rows.join(part, F.col("head") == F.col("_c"), "left_semi").join(part, F.col("tail") == F.col("_c"), "left_semi")
    return both.groupBy("head", "last").agg(F.sum("n").alias("n"))


def compound_lexicon(texts: DataFrame, text_col: str = "text", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, pmi_ratio: int = PMI_RATIO,
                     max_pairs: int = MAX_HELD) -> DataFrame:
    """W2 beyond pairs: ``compound`` (its words joined by a space), ``words, n`` of two to ``max_words`` words; see :func:`lexicon_of_runs`."""
    runs = materialize(run_counts(texts, text_col), "runs")
    words = word_counts(runs)
    out = lexicon_of_runs(runs, words, max_words, min_count, pmi_ratio, max_pairs)
    discard(runs, words)
    return out


def lexicon_of_runs(runs: DataFrame, words: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, pmi_ratio: int = PMI_RATIO,
                    max_pairs: int = MAX_HELD) -> DataFrame:
    """:func:`compound_lexicon` of written runs ``words, n`` and their :func:`word_counts`.

    Level by level: a run of k words is a candidate only if its first and its
    last k - 1 words are compounds, and is one if it is seen ``min_count`` times
    and ``pmi_ratio`` times as often as its first k - 1 words and its last word
    would meet by chance (whole-number arithmetic).  A pair is seen no more often
    than either word, so only pairs of words seen ``min_count`` times are counted, as
    numbers; all words of a longer compound lie in a stretch whose neighbours are compounds.
    Up to ``max_pairs`` words or compounds of a level go to every task, and only such
    pairs, stretches and candidates are written.  With more, all are, and they meet the
    words or the level below before or after they are counted.
    """
    total = words.agg(F.sum("n")).scalar()
    dec = "decimal(38,0)"
    often = words.filter(F.col("n") >= min_count)
    last = often.select(F.col("text").alias("last"), F.col("n").alias("_nw"))
    scratch = []

    def kept(counts: DataFrame, head: DataFrame, last: DataFrame, on: tuple[str, str] = ("head", "last")) -> DataFrame:
        """Of counted groups: those seen together often enough, with the counts of their ``head`` (``_nh``) and ``last`` word (``_nw``)."""
        j = counts.filter(F.col("n") >= min_count).join(head, on[0]).join(last, on[1])
        enough = F.col("n").cast(dec) * total.cast(dec) >= F.lit(pmi_ratio).cast(dec) * F.col("_nh").cast(dec) * F.col("_nw").cast(dec)
        return j.filter(enough).select(F.concat_ws(" ", "head", "last").alias("compound"), "n")

    if often.count() <= max_pairs:
        known = numbered(often)
        scratch.append(known)
        level = kept(*_held_pairs(runs, known), ("_a", "_b"))
    else:
        w = with_pinned(runs, {"_w": F.split("words", " ")})
        pairs = explode_computed(w, _with_next(pinned(F.col("_w"))), ["n"], "i", "p").filter("p.w_next IS NOT NULL")
        pairs = pairs.groupBy(F.col("p.w").alias("head"), F.col("p.w_next").alias("last")).agg(F.sum("n").alias("n"))
        level = kept(pairs, last.select(F.col("last").alias("head"), F.col("_nw").alias("_nh")), last)
    level = materialize(level, "compounds")
    out = level.withColumn("words", F.lit(2))
    stretches = runs
    if max_words > 2 and level.count() <= max_pairs:
        stretches = materialize(_chains(runs, level), "words-of-texts")
        scratch.append(stretches)
    for k in range(3, max_words + 1):
        counts = (_held_groups if level.count() <= max_pairs else _joined_groups)(stretches, level, k)
        level = materialize(kept(counts, level.select(F.col("compound").alias("head"), F.col("n").alias("_nh")), last), "compounds")
        out = out.unionByName(level.withColumn("words", F.lit(k)))
    if scratch:
        discard(*scratch)
    return out


def longest_compounds(tokens: list[str], compounds, max_words: int = MAX_WORDS) -> list[str]:
    """Tokens with compounds joined by ``_``: from left to right, at each place the longest one."""
    out, at = [], 0
    while at < len(tokens):
        k = min(max_words, len(tokens) - at)
        while k > 1 and " ".join(tokens[at:at + k]) not in compounds:
            k -= 1
        out.append("_".join(tokens[at:at + k]))
        at += k
    return out


def merge_longest(texts: DataFrame, lexicon: DataFrame, key: str, text_col: str = "text", max_words: int = MAX_WORDS, max_compounds: int = MAX_PAIRS) -> DataFrame:
    """Apply a :func:`compound_lexicon`, longest compounds first; a null text is empty.

    The lexicon goes to every task, so it must not be larger than ``max_compounds``: raise
    ``min_count`` for a larger corpus, or merge by pairs with :func:`merge_compounds`.
    """
    found = materialize(lexicon.select("compound").distinct(), "lexicon")
    if found.count() > max_compounds:
        raise ValueError(f"more than {max_compounds} compounds")
    held = texts.sparkSession.sparkContext.broadcast(frozenset(r.compound for r in found.collect()))

    @F.arrow_udf("string")
    def merged(joined: pa.Array) -> pa.Array:
        return pa.array([" ".join(longest_compounds(t.split(" "), held.value, max_words)) for t in joined.to_pylist()], pa.string())

    return texts.select(key, merged(F.array_join(TK.tokens(text_col), " ")).alias(text_col))


def _glued(joined: Column, hits: Column | None, lexicon=None) -> Column:
    """Tokens, joined by spaces, with the pairs of a lexicon (of all texts, or each text's ``hits``) joined by ``_``, left to right."""

    def glue(text: str, pairs) -> str:
        if not pairs:
            return text
        out, held = [], None  # the token that may still be the first of a pair
        for w in text.split(" "):
            if held is not None and held + MARK + w in pairs:
                out.append(f"{held}_{w}")
                held = None
            else:
                if held is not None:
                    out.append(held)
                held = w
        if held is not None:
            out.append(held)
        return " ".join(out)

    if hits is None:

        @F.arrow_udf("string")
        def with_lexicon(texts: pa.Array) -> pa.Array:
            return pa.array([glue(t, lexicon.value) for t in texts.to_pylist()], pa.string())

        return with_lexicon(joined)

    @F.arrow_udf("string")
    def with_hits(texts: pa.Array, hits: pa.Array) -> pa.Array:
        return pa.array([glue(t, set(h or ())) for t, h in zip(texts.to_pylist(), hits.to_pylist(), strict=True)], pa.string())

    return with_hits(joined, hits)


def merge_compounds(texts: DataFrame, lexicon: DataFrame, key: str, text_col: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Apply a lexicon: in each text, a lexicon pair of adjacent tokens is
    joined with ``_`` (left to right, non-overlapping); tokens re-joined with
    spaces.  A null text is empty; rows with a null or repeated key are rows like any others.

    A lexicon of at most ``max_pairs`` goes to every task (a few dozen MB) and the
    texts are merged where they lie.  A larger one stays a table: the tokens are
    written once, each text's distinct pairs meet the lexicon, and the hits come
    back to their text by its row number, which moves the tokens once.
    """
    pairs = materialize(lexicon.select(F.concat("w1", F.lit(MARK), "w2").alias("pair")), "lexicon")
    joined = F.array_join(TK.tokens(text_col), " ")
    if pairs.count() <= max_pairs:
        spark = texts.sparkSession
        held = spark.sparkContext.broadcast(frozenset(r.pair for r in pairs.collect()))
        return texts.select(key, _glued(joined, None, held).alias(text_col))
    rows = materialize(texts.select(key, joined.alias("_j")).withColumn("_row", F.monotonically_increasing_id()), "tokens")
    # a pair is one string (arrays of structs have no hashed distinct)
    t = with_pinned(rows.select("_row", F.split("_j", " ").alias("_t")), {"_w": _words_of(F.col("_t"))})
    zipped = with_pinned(t.select("_row", pinned(F.col("_w")).alias("_w")), {"_p": _with_next(F.col("_w"))})
    found = F.transform(pinned(F.col("_p")), lambda p: F.concat(p["w"], F.lit(MARK), p["w_next"]))  # null beside punctuation
    cand = explode_computed(zipped, F.array_distinct(found), ["_row"], None, "pair").filter(F.col("pair").isNotNull())
    hits = cand.join(pairs, "pair").groupBy("_row").agg(F.collect_list("pair").alias("_hits"))
    return rows.join(hits, "_row", "left").select(key, _glued(F.col("_j"), F.col("_hits")).alias(text_col))
