"""Small tables with every awkward case, shared by the tests."""

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row string, size string, k1 string, bucket string"
PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls read old maps by candle light near a quiet river bend"


def varied(n: int, seed: int = 0) -> str:
    """n different words."""
    return " ".join(f"w{(seed * 7919 + i * 31) % 100003}x{i}" for i in range(n))


def documents(spark):
    base = varied(60)
    near = base.replace("x30", "CHANGED", 1)
    rows = [
        (1, base, "a"), (2, near, "a"), (3, base, "b"), (3, base, "b"), (4, varied(60, 5), "b"),
        (5, None, None), (6, "", "c"), (7, " \t\n ", "c"), (8, "one two three", "c"), (9, "one two three", None),
        (10, "shared line of text here\nown line number ten\nshared line of text here", "a"),
        (11, " Shared LINE of text here \nown line number eleven", "a"),
        (12, PROSE + "\n" + PROSE + "\n" + PROSE, "b"), (13, "#### $$$$ %%%% " + varied(12, 9), "b"),
        (None, base, "a"), (None, None, None), (None, varied(40, 3), None), (14, varied(5000, 11), "a"), (15, "x" * 30000, "d"),
        (16, "é" * 9 + "\n" + "é" * 10, "d"), (17, "é" * 9 + "\n" + "é" * 10, "d"),
        (18, "Ünïcode 漢字 text 😀 with several more words to make ten of them", "ü"),
    ]
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "x", "y", "z", "k", "b") for i, t, s in rows], DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
