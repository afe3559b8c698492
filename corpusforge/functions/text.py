"""Scalar text rules as Column -> Column functions (all JVM-side regex built-ins).

Python's ``re`` and Java's ``java.util.regex`` disagree on ``\\s``, ``\\w`` and
``.``; every pattern below is spelled so Java gives the result Python's ``re``
gives on ``str`` input:

* ``\\s`` / ``str.isspace``  -> the explicit class ``WS`` below
* ``\\w``                    -> ``[\\p{L}\\p{N}_]`` (combining marks are *not* word chars)
* ``.``                      -> ``(?d)`` (UNIX_LINES: only ``\\n`` ends a line)
* ``\\Z``                    -> ``\\z``
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the rule set the corpus was defined with.
# ---------------------------------------------------------------------------
# Python whitespace (str.isspace / re \s): code-point ranges, inclusive.
WS_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)


def _range_body(ranges) -> str:
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


def _complement(ranges, top: int = 0x10FFFF):
    out, nxt = [], 0
    for a, b in sorted(ranges):
        if a > nxt:
            out.append((nxt, a - 1))
        nxt = b + 1
    if nxt <= top:
        out.append((nxt, top))
    return out


WS_BODY = _range_body(WS_RANGES)
WS = "[" + WS_BODY + "]"
# "Not whitespace" spelled as positive ranges: Java evaluates a negated class
# with non-ASCII members an order of magnitude slower than the same set
# written positively.
NOT_WS = "[" + _range_body(_complement(WS_RANGES)) + "]"


# Python \w on str input.
WORD_BODY = r"\p{L}\p{N}_"

TAG = r"(?d)<.*?>"                                   # T1
WHITELIST = r"[^" + WORD_BODY + r".,;:!?\"()\-" + WS_BODY + "]"  # T3 (keeps \w \s . , ; : ! ? " ( ) -)
NL_AFTER_TEXT = r"(?<=[^\.\?\!])\n+"                 # T5 -> ". "
NL_AFTER_TERM = r"(?<=[\.\?\!])\n+"                  # T6 -> " "
QUOTES = "[“”\"]"                          # T7: “ ” "
PHOTO_CREDIT = "(?d)\\(Ảnh:.*?\\)"               # T8: (Ảnh: ...)
DATELINE = r"^VTV\.vn" + WS + "*-" + WS + "*"        # T9
PROMO = r"(?d)\*.*?VTVGo.*?\." + WS + r"*\z"         # T10
BRAND = r"VTV\." + WS + "?vn"                        # T11 -> "VTV.vn"
TERMINATORS = "[?!…;]+"                         # T12: ? ! … ; -> "."
NL_AFTER_TEXT_D = r"(?<=[^\.\n])\n+"                 # T13 -> ". "
NL_AFTER_DOT_D = r"(?<=[\.])\n+"                     # T14 -> " "
DOT_RUN = r"\.{2,}"                                  # T15 -> "."
SUMMARY_FALLBACK_WORDS = 50                          # T16
MIN_CONTENT_WORDS = 50                               # P2
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_to_empty(col) -> Column:
    """Null -> ''."""
    return F.coalesce(_c(col), F.lit(""))


def strip_tags(col) -> Column:
    """Remove ``<...>`` spans that do not cross a newline."""
    return F.regexp_replace(_c(col), TAG, "")


def collapse_ws(col) -> Column:
    """Runs of (Python) whitespace -> one space."""
    return F.regexp_replace(_c(col), WS + "+", " ")


def whitelist_chars(col) -> Column:
    """Drop everything but word chars, whitespace and . , ; : ! ? " ( ) -."""
    return F.regexp_replace(_c(col), WHITELIST, "")


def py_strip(col) -> Column:
    """Python ``str.strip()`` (Unicode whitespace at both ends)."""
    return F.regexp_replace(_c(col), "^" + WS + "+|" + WS + r"+\z", "")


def strip_spaces(col) -> Column:
    """T4 after T2: only U+0020 can remain at the ends, so ``trim`` suffices."""
    return F.trim(_c(col))


def newline_to_period(col) -> Column:
    """T5: a newline run after a non-terminator becomes ``'. '``."""
    return F.regexp_replace(_c(col), NL_AFTER_TEXT, ". ")


def newline_to_space(col) -> Column:
    """A newline run after ``. ? !`` becomes a space."""
    return F.regexp_replace(_c(col), NL_AFTER_TERM, " ")


def strip_quotes(col) -> Column:
    """T7."""
    return F.regexp_replace(_c(col), QUOTES, "")


def strip_photo_credit(col) -> Column:
    """T8."""
    return F.regexp_replace(_c(col), PHOTO_CREDIT, "")


def strip_dateline(col) -> Column:
    """Leading ``VTV.vn -`` only."""
    return F.regexp_replace(_c(col), DATELINE, "")


def strip_promo(col) -> Column:
    """Trailing ``* ... VTVGo ... .`` at the very end.

    Once newlines are gone the lazy ``.*?`` runs to the end of the text from
    every ``*``; the pattern needs the literal ``VTVGo``, so texts without it
    skip the regex (same result, no quadratic scan)."""
    c = _c(col)
    return F.when(F.instr(c, "VTVGo") > 0, F.regexp_replace(c, PROMO, "")).otherwise(c)


def repair_brand(col) -> Column:
    """``VTV. vn`` -> ``VTV.vn``."""
    return F.regexp_replace(_c(col), BRAND, "VTV.vn")


def unify_terminators(col) -> Column:
    """Runs of ``? ! … ;`` -> ``.``."""
    return F.regexp_replace(_c(col), TERMINATORS, ".")


def newline_to_period_d(col) -> Column:
    """Newline run after neither ``.`` nor newline -> ``'. '``."""
    return F.regexp_replace(_c(col), NL_AFTER_TEXT_D, ". ")


def newline_to_space_d(col) -> Column:
    """Newline run after ``.`` -> space."""
    return F.regexp_replace(_c(col), NL_AFTER_DOT_D, " ")


def collapse_dots(col) -> Column:
    """T15."""
    return F.regexp_replace(_c(col), DOT_RUN, ".")


def word_count(col) -> Column:
    """``len(s.split())`` - number of maximal non-whitespace runs (bigint)."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.regexp_count(c, F.lit(NOT_WS + "+"))).cast("bigint")


def spaced_word_count(col) -> Column:
    """Word count of text already collapsed by T2/T4 (single spaces, trimmed).

    Equal to :func:`word_count` on such text but split-only (no regex scan).
    """
    c = _c(col)
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " "))).cast("bigint")


def words(col) -> Column:
    """``s.split()`` as an array (Unicode whitespace, no empties)."""
    return F.regexp_extract_all(_c(col), F.lit("(" + NOT_WS + "+)"), 1)


def first_words(col, n: int) -> Column:
    """``' '.join(s.split()[:n])`` without materialising every word: extract
    the prefix holding the first ``n`` words, then collapse and trim it."""
    prefix = F.regexp_extract(_c(col), "^" + WS + "*((?:" + NOT_WS + "+" + WS + "*){0," + str(n) + "})", 1)
    return F.trim(F.regexp_replace(prefix, WS + "+", " "))


def summary_fallback(summary, content, n: int = SUMMARY_FALLBACK_WORDS) -> Column:
    """Empty summary -> first ``n`` words of content."""
    s = _c(summary)
    return F.when(s == "", first_words(null_to_empty(content), n)).otherwise(s)


def article_id(source, url) -> Column:
    """T17 (deterministic form): ``{source}_{md5(url)}``, the whole digest."""
    return F.concat_ws("_", null_to_empty(source), F.md5(null_to_empty(url)))


def default_fields(*cols: str) -> list[Column]:
    """Missing metadata defaults to ''."""
    return [null_to_empty(c).alias(c) for c in cols]


def format_scraped_at(ts) -> Column:
    """``%Y-%m-%d %H:%M:%S``."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def raw_file_name(source, scraped_epoch, category) -> Column:
    """``{source}_{epoch}_{category}.json``."""
    return F.concat(_c(source), F.lit("_"), _c(scraped_epoch).cast("string"), F.lit("_"), _c(category), F.lit(".json"))


def local_text_epoch(text, utc_offset_seconds: int = 7 * 3600) -> Column:
    """Epoch seconds of a zone-less ``yyyy-MM-dd HH:mm:ss`` local time with a
    fixed UTC offset, computed from its fields (independent of the session
    time zone); null if the text is no such time."""
    t = _c(text)
    day = F.datediff(F.substring(t, 1, 10).try_cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    hms = (
        F.substring(t, 12, 2).try_cast("bigint") * 3600
        + F.substring(t, 15, 2).try_cast("bigint") * 60
        + F.substring(t, 18, 2).try_cast("bigint")
    )
    return day * 86400 + hms - utc_offset_seconds


# ---------------------------------------------------------------------------
# Composed cleaners (before the sentence chunker)
# ---------------------------------------------------------------------------
def clean_a(col) -> Column:
    """A: T0 T1 T2 T3 T4."""
    c = null_to_empty(col)
    return strip_spaces(whitelist_chars(collapse_ws(strip_tags(c))))


def clean_b(col) -> Column:
    """B: T0 T5 T6 T7 T2 T4."""
    c = null_to_empty(col)
    c = strip_quotes(newline_to_space(newline_to_period(c)))
    return strip_spaces(collapse_ws(c))


def clean_c_text(col) -> Column:
    """C before chunking: T0 T5 T6 T7 T8 T9 T10 T11 T2 T4."""
    c = null_to_empty(col)
    c = strip_quotes(newline_to_space(newline_to_period(c)))
    c = repair_brand(strip_promo(strip_dateline(strip_photo_credit(c))))
    return strip_spaces(collapse_ws(c))


def clean_d_text(col) -> Column:
    """D before chunking: T0 T12 T13 T14 T7 T8 T9 T10 T11 T15 T2 T4."""
    c = null_to_empty(col)
    c = newline_to_space_d(newline_to_period_d(unify_terminators(c)))
    c = strip_quotes(c)
    c = repair_brand(strip_promo(strip_dateline(strip_photo_credit(c))))
    c = collapse_dots(c)
    return strip_spaces(collapse_ws(c))
