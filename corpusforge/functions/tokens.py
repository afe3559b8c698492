"""Word segmentation (W1) as Column functions.

The original pipeline delegates to a pre-trained Vietnamese segmenter and
joins its tokens with single spaces; a token may itself contain spaces
(compounds), so the visible effect of ``' '.join`` is mostly that punctuation
is detached.  The built-in rule below reproduces that visible effect on the
JVM: a token is a run of word characters, optionally joined by ``. , - /``
between word characters (``1.000``, ``VTV.vn``, ``COVID-19``), or any single
other non-space character.  A real segmenter can be plugged in through
``tokenizer=`` and runs in an Arrow-batched pandas UDF.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from corpusforge.functions import text as T

W = "[" + T.WORD_BODY + "]"
WS = "[" + T.WS_BODY + "]"
TOKEN = W + "+(?:[.,\\-/]" + W + "+)*|[^" + T.WORD_BODY + T.WS_BODY + "]"

# Word tokens with only white space between them; possessive, so that Java matches a run of any length without recursion.
_WORD = W + "++(?:[.,\\-/]" + W + "++)*+"
RUN = _WORD + "(?:" + WS + "++" + _WORD + ")*+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col) -> Column:
    """array<string> of tokens (empty array for null)."""
    return F.regexp_extract_all(T.null_to_empty(col), F.lit("(" + TOKEN + ")"), 1)


def runs(col) -> Column:
    """array<string>: the runs of word tokens between others, as they stand in the text (see :func:`spaced`)."""
    return F.regexp_extract_all(T.null_to_empty(col), F.lit("(" + RUN + ")"), 1)


def runs_and_others(col) -> Column:
    """array<string>: a text's runs, :func:`spaced`, and between them its other tokens, in order."""
    return F.regexp_extract_all(spaced(T.null_to_empty(col)), F.lit("(" + RUN + "|[^" + T.WORD_BODY + T.WS_BODY + "])"), 1)


def spaced(run) -> Column:
    """A run with one space between its words, at which Java splits without a regex."""
    return F.regexp_replace(run, F.lit(WS + "+"), F.lit(" "))


def tokenize(col, tokenizer: Callable[[str], list[str]] | None = None) -> Column:
    """Tokens joined by one space; null/non-string -> ''."""
    if tokenizer is None:
        return F.array_join(tokens(col), " ")

    @F.pandas_udf(TY.StringType())
    def _seg(s: pd.Series) -> pd.Series:
        return s.map(lambda x: " ".join(tokenizer(x)) if isinstance(x, str) else "")

    return _seg(_c(col))
