"""T* rules and the four cleaners on the probe strings (FIXTURES section 5)."""

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as T

PROBES = [
    # input, A, B, C (before chunking), D (before chunking)
    ("\nA b.\nC d\nE?\n", "A b. C d E?", "A b. C d. E?", "A b. C d. E?", "A b. C d. E."),
    ("\n\nFoo", "Foo", ". Foo", ". Foo", "Foo"),
    ("foo.\n\nbar", "foo. bar", "foo. . bar", "foo. . bar", "foo. bar"),
    ("“a” \"b\"", "a \"b\"", "a b", "a b", "a b"),
    ("x (Ảnh: VGP) y", "x (Ảnh: VGP) y", "x (Ảnh: VGP) y", "x y", "x y"),
    ("VTV.vn - xin", "VTV.vn - xin", "VTV.vn - xin", "xin", "xin"),
    ("a b.* Mời xem VTVGo!", "a b. Mời xem VTVGo!", "a b.* Mời xem VTVGo!", "a b.* Mời xem VTVGo!", "a b."),
    ("a b.* Mời xem VTVGo.", "a b. Mời xem VTVGo.", "a b.* Mời xem VTVGo.", "a b.", "a b."),
    ("VTV. vn nói", "VTV. vn nói", "VTV. vn nói", "VTV.vn nói", "VTV.vn nói"),
    ("a…b?!c;d", "ab?!c;d", "a…b?!c;d", "a…b?!c;d", "a.b.c.d"),
    ("<b>a</b>  50% x/y", "a 50 xy", "<b>a</b> 50% x/y", "<b>a</b> 50% x/y", "<b>a</b> 50% x/y"),
    ("", "", "", "", ""),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PROBES)], "i int, s string")
    out = df.select(
        "i",
        T.clean_a("s").alias("a"),
        T.clean_b("s").alias("b"),
        T.clean_c_text("s").alias("c"),
        T.clean_d_text("s").alias("d"),
    ).orderBy("i")
    return [(r.a, r.b, r.c, r.d) for r in out.collect()]


@pytest.mark.parametrize("idx", range(len(PROBES)))
def test_cleaner_probes(cleaned, idx):
    assert cleaned[idx] == PROBES[idx][1:]


def test_null_becomes_empty(spark):
    df = spark.createDataFrame([(None,)], "s string")
    r = df.select(T.clean_a("s"), T.clean_b("s"), T.clean_c_text("s"), T.clean_d_text("s"), T.word_count("s")).first()
    assert tuple(r) == ("", "", "", "", 0)


def test_whitespace_and_word_rules(spark):
    # every BMP white space code point that Python's str knows, combining marks, and symbols around words
    ws = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
    # text, with white space collapsed, with other characters dropped, words
    samples = [
        (f"a{ws}b", "a b", f"a{ws}b", 2),
        ("x\u0301y z-w", "x\u0301y z-w", "xy z-w", 2),
        ("tiếng  Việt\tmới", "tiếng Việt mới", "tiếng  Việt\tmới", 3),
        ("½ ① 3² _under_ score", "½ ① 3² _under_ score", "½ ① 3² _under_ score", 5),
        ('a@b #c $5 "q" (r) x/y', 'a@b #c $5 "q" (r) x/y', 'ab c 5 "q" (r) xy', 6),
        ("tab\tnl\nvt\x0bff\x0ccr\rfs\x1cgs\x1d", "tab nl vt ff cr fs gs ", "tab\tnl\nvt\x0bff\x0ccr\rfs\x1cgs\x1d", 7),
    ]
    df = spark.createDataFrame([(k, s[0]) for k, s in enumerate(samples)], "k int, s string")
    got = df.select(T.collapse_ws("s").alias("c"), T.whitelist_chars("s").alias("w"), T.word_count("s").alias("n"), "k").orderBy("k").collect()
    assert [(r.c, r.w, r.n) for r in got] == [s[1:] for s in samples]


def test_summary_fallback_and_id(spark):
    words = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([("", words, "src", "u"), ("kept", words, "src", "u")], "s string, c string, src string, url string")
    r = df.select(T.summary_fallback("s", "c").alias("s"), T.article_id("src", "url").alias("id")).collect()
    assert r[0].s == " ".join(f"w{i}" for i in range(50))
    assert r[1].s == "kept"
    assert r[0].id.startswith("src_") and len(r[0].id) == 4 + 32


def test_word_rules_on_astral_and_controls(spark):
    samples = ["𝐀𝐁 c\x00d\x1be", "\U0001F600 x", "a​b c", "　lead trail　", "", "   "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(T.word_count("s").alias("n"), T.first_words("s", 2).alias("f")).collect()
    assert [r.n for r in got] == [len(s.split()) for s in samples]
    assert [r.f for r in got] == [" ".join(s.split()[:2]) for s in samples]
