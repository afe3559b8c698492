"""Sentence split and the long-sentence re-packer (N1-N6) as Column functions.

The re-packer is a left fold over the comma parts of a sentence, written with
Spark's ``aggregate`` higher-order function so it stays on the JVM.  The fold
keeps a running word count of the packed buffer (``n``) instead of re-splitting
it on every step; ``open`` records that the buffer ends with ``", "`` (the last
packed part was empty), in which case the next ``,`` becomes a word of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions import text as T

# The piece size of the re-packer and the long-sentence report.
MAX_WORDS = 128
LONG_SENTENCE_WORDS = 218


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _n_words_spaced(s: Column) -> Column:
    """Words of a trimmed, single-spaced string (int): spaces + 1, no array built."""
    return F.when(s == "", F.lit(0)).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1)


def split_sentences(col, collapsed: bool = True) -> Column:
    """Split on every ``.``, strip, drop empties -> array<string>.

    ``collapsed=True`` assumes T2/T4 already ran (only single spaces remain),
    so ``trim`` equals Python's ``strip``; otherwise the Unicode-aware strip
    is used.
    """
    strip = F.trim if collapsed else T.py_strip
    parts = F.transform(F.split(T.null_to_empty(col), r"\."), lambda x: strip(x))
    return F.filter(parts, lambda x: x != "")


def sentence_count(col, collapsed: bool = True) -> Column:
    """N5."""
    return F.size(split_sentences(col, collapsed)).cast("bigint")


def _slices(words: Column, n: Column, max_words: int) -> Column:
    """Cut ``words`` (n of them, n >= 1) into max_words slices, each word + ' '."""
    last = F.floor((n - 1) / max_words).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.concat(F.array_join(F.slice(words, i * max_words + 1, max_words), " "), F.lit(" ")),
    )


def _pack_sentence(s: Column, max_words: int, carry_bug: bool) -> Column:
    """N2+N3 for one sentence known to exceed ``max_words`` words."""
    parts = F.transform(F.split(s, ","), lambda p: F.trim(p))
    empty = F.array().cast("array<string>")
    init = F.struct(
        empty.alias("out"),
        F.lit("").alias("temp"),
        F.lit(0).alias("n"),
        F.lit(False).alias("open"),
    )

    def step(acc: Column, p: Column) -> Column:
        out, temp, n, open_ = acc["out"], acc["temp"], acc["n"], acc["open"]
        l = _n_words_spaced(p)
        fits = n + l + 1 <= max_words
        has_temp = temp != ""
        # -- fits: append to the buffer
        fit_temp = F.when(has_temp, F.concat(temp, F.lit(", "), p)).otherwise(p)
        fit_n = F.when(has_temp, n + l + F.when(open_, 1).otherwise(0)).otherwise(l)
        fit_open = has_temp & (p == "")
        # -- does not fit: flush the buffer, emit the part in slices
        words = F.split(p, " ")
        slices = F.when(l > 0, _slices(words, l, max_words)).otherwise(empty)
        if carry_bug:
            # the buffer is flushed but not cleared: it is glued to the first slice
            slices = F.when(
                has_temp & (l > 0),
                F.concat(F.array(F.concat(temp, F.element_at(slices, 1))), F.slice(slices, 2, 1 << 30)),
            ).otherwise(slices)
        flushed = F.concat(out, F.when(has_temp, F.array(temp)).otherwise(empty), slices)
        return F.when(
            fits,
            F.struct(out.alias("out"), fit_temp.alias("temp"), fit_n.alias("n"), fit_open.alias("open")),
        ).otherwise(
            F.struct(flushed.alias("out"), F.lit("").alias("temp"), F.lit(0).alias("n"), F.lit(False).alias("open"))
        )

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.when(acc["temp"] != "", F.array(acc["temp"])).otherwise(empty))

    return F.aggregate(parts, init, step, finish)


def chunk_sentences(sentences, max_words: int = MAX_WORDS, carry_bug: bool = False) -> Column:
    """N3 on an array of sentences (already split and stripped) -> array<string>.

    A sentence of at most ``max_words`` words passes untouched.  A longer one
    is walked by comma part: a part joins the buffer (with ``', '``) while
    ``words(buffer) + words(part) + 1 <= max_words``; otherwise the buffer is
    emitted and the part is emitted at once in ``max_words`` slices, each word
    followed by a space.  ``carry_bug=True`` reproduces the original rule that
    glues the flushed buffer onto the first slice.

    Higher-order functions are interpreted (no codegen and no common
    subexpression elimination), so pass a column *reference* here: the
    sentences are read three times.  :func:`with_chunks` does that for you.
    """
    sents = _c(sentences)
    long_ = F.exists(sents, lambda s: _n_words_spaced(s) > max_words)
    packed = F.flatten(
        F.transform(
            sents,
            lambda s: F.when(_n_words_spaced(s) <= max_words, F.array(s)).otherwise(
                _pack_sentence(s, max_words, carry_bug)
            ),
        )
    )
    # The fold only runs for rows that have a long sentence.
    return F.when(long_, packed).otherwise(sents)


def chunk_pieces(col, max_words: int = MAX_WORDS, carry_bug: bool = False) -> Column:
    """N3 on collapsed text in one expression (convenient; see :func:`with_chunks` for the fast form)."""
    return chunk_sentences(split_sentences(col, collapsed=True), max_words, carry_bug)


def with_chunks(df, outputs: dict, max_words: int = MAX_WORDS, carry_bug: bool = False, joined: bool = True):
    """Add re-packed columns: ``outputs`` maps new column -> collapsed-text Column.

    Two projections: the first splits the cleaned text into sentences (the
    regex chain runs once), the second re-packs from the column.  Catalyst
    keeps them apart because collapsing would duplicate the expensive array.
    ``joined=True`` yields the N4 string, else the array of pieces.
    """
    from corpusforge.operators.plan_utils import pinned, with_pinned

    # 1) cleaned text in its own (code-generated) projection
    df = with_pinned(df, {f"_text_{k}": v for k, v in outputs.items()})
    # 2) sentences from the text column; 3) re-pack from the sentence column
    tmp = {f"_sents_{k}": pinned(split_sentences(F.col(f"_text_{k}"), collapsed=True)) for k in outputs}
    df = df.withColumns(tmp)
    final = {}
    for k in outputs:
        pieces = chunk_sentences(F.col(f"_sents_{k}"), max_words, carry_bug)
        final[k] = join_pieces(pieces) if joined else pieces
    return df.withColumns(final).drop(*tmp.keys(), *[f"_text_{k}" for k in outputs], "_pin")


def join_pieces(pieces) -> Column:
    """Every piece followed by ``'. '`` (trailing space kept; no piece -> '')."""
    p = _c(pieces)
    return F.when(F.size(p) > 0, F.concat(F.array_join(p, ". "), F.lit(". "))).otherwise(F.lit(""))


def fit_to_max_words(col, max_words: int = MAX_WORDS, carry_bug: bool = False) -> Column:
    """N3 + N4 on collapsed text -> string."""
    return join_pieces(chunk_pieces(col, max_words, carry_bug))


def clean_c(col, carry_bug: bool = False) -> Column:
    """Cleaner C including the re-packer."""
    return fit_to_max_words(T.clean_c_text(col), carry_bug=carry_bug)


def clean_d(col, carry_bug: bool = False) -> Column:
    """Cleaner D including the re-packer."""
    return fit_to_max_words(T.clean_d_text(col), carry_bug=carry_bug)
