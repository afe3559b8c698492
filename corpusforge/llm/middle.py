"""Operator 12, fill-in-the-middle: cuts found by SWAR words.

The UTF-8 bytes of a whole column are viewed as 64-bit words.  In each word,
arithmetic marks the bytes that end a code point (a byte ends one if the next
byte is no continuation byte); ``bitwise_count`` counts the marks per word.  The
byte where the k-th code point ends is found by searching the running counts
for its word, then by a select inside the word: a multiplication turns the marks into
running counts per byte, and comparing all eight with the wanted number at once
gives the byte.

A document's cuts and form follow from its id and the seed by a digest, so they
do not depend on partitions or on the run.  A text that holds a marker stays
plain, so the markers in an output always are the operator's, and
:func:`restored` gives the text back.

Everything is local to a row: nothing is shuffled.

Defined results: a null text is empty; an empty text is plain; a null id counts
as the empty string in the digest; equal rows give equal results; extra columns
stay inside the ``row`` struct of :func:`transformed`; an empty table gives an
empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import words as W

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM = 90  # of 100: the share of documents that are transformed
SPM_BELOW = 20  # of 100: the share of these whose suffix comes first

U = np.uint64
LOW = U(0x0101010101010101)
HIGH = U(0x8080808080808080)


class Units:
    """Code points of a run of UTF-8 bytes: how many end before a byte, and where the k-th ends."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        padded = np.zeros((n + 15) // 8 * 8, np.uint8)
        padded[:n] = data
        w = padded.view("<u8")
        begins = ((w >> U(7)) & ~(w >> U(6)) & LOW) ^ LOW
        ends = begins >> U(8)
        ends[:-1] |= begins[1:] << U(56)
        # the bytes behind the data are no units
        ends[n // 8] &= (U(1) << U(8 * (n % 8))) - U(1)
        ends[n // 8 + 1:] = 0
        self.ends = ends
        count = np.bitwise_count(ends)
        self.upto = np.cumsum(count, dtype=np.int64)
        self.before = self.upto - count

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end in the bytes before each position."""
        word = at >> 3
        inside = (U(1) << (U(8) * (at & 7).astype(U))) - U(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The position behind the k-th unit, counted from 1."""
        word = np.searchsorted(self.upto, k, "left")
        wanted = (k - self.before[word]).astype(U)
        reached = (((self.ends[word] * LOW) | HIGH) - wanted * LOW) & HIGH
        return 8 * word + 9 - np.bitwise_count(reached).astype(np.int64)


def cuts(data: np.ndarray, starts: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: its units, and units and byte position (in ``data``) of its two cuts."""
    units = Units(data)
    rank = units.rank(starts)
    n = np.diff(rank)
    a, b = h1 % (n + 1), h2 % (n + 1)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    places = []
    for k in (lo, hi):
        at = starts[:-1].copy()
        some = k > 0
        at[some] = units.select((rank[:-1] + k)[some])
        places.append(at)
    return n, lo, hi, *places


FOUND = "n bigint, prefix_chars bigint, middle_chars bigint, output string"


def _transform(text: Column, form: Column, h1: Column, h2: Column) -> Column:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array, forms: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        data, starts = W.flat(texts)
        n, lo, hi, x, y = cuts(data, starts, h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False))
        raw, out, forms = memoryview(data), [], forms.to_pylist()
        for form, a, b, c, d in zip(forms, starts[:-1].tolist(), x.tolist(), y.tolist(), starts[1:].tolist(), strict=True):
            if form == "psm":
                out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
            elif form == "spm":
                out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
            else:
                out.append(bytes(raw[a:d]))
        plain = np.array([form == "plain" for form in forms], bool)
        columns = [pa.array(n), pa.array(lo, mask=plain), pa.array(hi - lo, mask=plain), pa.array(out, pa.string())]
        return pa.StructArray.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    return run(text, form, h1, h2)


def digest_numbers(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned numbers of a document: the first 8-digit groups of a digest of seed and id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def transformed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``row`` (the document's columns), ``form`` and ``n, prefix_chars, middle_chars, output`` of every document."""
    t = F.coalesce(docs[text], F.lit(""))
    h1, h2, h3, h4 = digest_numbers(docs[doc_id], seed)
    marked = F.contains(t, F.lit(PREFIX)) | F.contains(t, F.lit(SUFFIX)) | F.contains(t, F.lit(MIDDLE))
    form = F.when((t == "") | marked | (h3 % 100 >= PLAIN_FROM), "plain").when(h4 % 100 < SPM_BELOW, "spm").otherwise("psm")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), t.alias("t"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    return rows.select("row", "form", _transform(F.col("t"), F.col("form"), F.col("h1"), F.col("h2")).alias("x")).select("row", "form", "x.*")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    first, second, middle = (F.get(F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}"), F.lit(k)) for k in (1, 2, 3))
    psm = F.concat(first, middle, second)
    spm = F.concat(second, middle, first)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def middle_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its cuts, and digests of the output and of the text restored from it."""
    out = transformed(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")))
    return out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
