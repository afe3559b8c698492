"""Independent DuckDB SQL for every registered query (the correctness oracle).

DuckDB uses RE2: no lookbehind, ``\\x{..}`` code points, ``.`` already stops
only at ``\\n``.  Lookbehind rules are re-expressed by consuming the previous
character and putting it back (``([^.?!])\\n+`` -> ``\\1. ``), which matches
the same runs because a newline run is always consumed whole.
"""

from __future__ import annotations

# Python whitespace (str.isspace) as an RE2 class body.
WS_BODY = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = "[" + WS_BODY + "]"
NOT_WS = "[^" + WS_BODY + "]"


def rr(x: str, pat: str, rep: str) -> str:
    return f"regexp_replace({x}, '{pat}', '{rep}', 'g')"


def nz(x: str) -> str:
    return f"coalesce({x}, '')"


def strip_tags(x):
    return rr(x, "<.*?>", "")


def collapse_ws(x):
    return rr(x, WS + "+", " ")


def whitelist(x):
    return rr(x, r'[^\p{L}\p{N}_.,;:!?"()\-' + WS_BODY + "]", "")


def nl_period(x):
    return rr(x, r"([^.?!])\n+", r"\1. ")


def nl_space(x):
    return rr(x, r"([.?!])\n+", r"\1 ")


def quotes(x):
    return rr(x, '[“”"]', "")


def photo(x):
    return rr(x, r"\(Ảnh:.*?\)", "")


def dateline(x):
    return rr(x, r"^VTV\.vn" + WS + "*-" + WS + "*", "")


def promo(x):
    return rr(x, r"\*.*?VTVGo.*?\." + WS + r"*\z", "")


def brand(x):
    return rr(x, r"VTV\." + WS + "?vn", "VTV.vn")


def terminators(x):
    return rr(x, "[?!…;]+", ".")


def nl_period_d(x):
    return rr(x, r"([^.\n])\n+", r"\1. ")


def nl_space_d(x):
    return rr(x, r"\.\n+", ". ")


def dots(x):
    return rr(x, r"\.{2,}", ".")


def word_count(x):
    return f"CAST(len(regexp_extract_all({nz(x)}, '{NOT_WS}+')) AS BIGINT)"


def words(x):
    return f"regexp_extract_all({nz(x)}, '{NOT_WS}+')"


def py_strip(x):
    return rr(x, "^" + WS + "+|" + WS + "+$", "")


def clean_a(x):
    return f"trim({whitelist(collapse_ws(strip_tags(nz(x))))})"


def clean_b(x):
    return f"trim({collapse_ws(quotes(nl_space(nl_period(nz(x)))))})"


def clean_c_text(x):
    c = quotes(nl_space(nl_period(nz(x))))
    c = brand(promo(dateline(photo(c))))
    return f"trim({collapse_ws(c)})"


def clean_d_text(x):
    c = nl_space_d(nl_period_d(terminators(nz(x))))
    c = brand(promo(dateline(photo(quotes(c)))))
    return f"trim({collapse_ws(dots(c))})"


def nw(s: str) -> str:
    """Words of a trimmed single-spaced string."""
    return f"(CASE WHEN {s} = '' THEN 0 ELSE len(string_split({s}, ' ')) END)"


def sentences(t: str, collapsed: bool = True) -> str:
    strip = "trim(x)" if collapsed else py_strip("x")
    return f"list_filter(list_transform(string_split({t}, '.'), lambda x: {strip}), lambda x: x <> '')"


def pack_struct(s: str, max_words: int = 128, carry_bug: bool = False) -> str:
    """Fold over the comma parts of one long sentence -> struct(out, temp, n, open)."""
    l = nw("p")
    slices = (
        f"list_transform(range(0, ({l} + {max_words - 1}) // {max_words}), "
        f"lambda k: array_to_string(string_split(p, ' ')[k * {max_words} + 1 : k * {max_words} + {max_words}], ' ') || ' ')"
    )
    if carry_bug:
        slices = f"list_transform({slices}, lambda x, i: CASE WHEN i = 1 AND acc.temp <> '' THEN acc.temp || x ELSE x END)"
    fit = (
        "struct_pack(out := acc.out, "
        "temp := CASE WHEN acc.temp <> '' THEN acc.temp || ', ' || p ELSE p END, "
        f"n := CASE WHEN acc.temp <> '' THEN acc.n + {l} + CASE WHEN acc.open THEN 1 ELSE 0 END ELSE {l} END, "
        "open := acc.temp <> '' AND p = '')"
    )
    flush = (
        "struct_pack(out := list_concat(acc.out, "
        "CASE WHEN acc.temp <> '' THEN [acc.temp] ELSE []::VARCHAR[] END, "
        f"{slices}), temp := '', n := 0, open := false)"
    )
    init = "struct_pack(out := []::VARCHAR[], temp := '', n := 0, open := false)"
    return (
        f"list_reduce(list_transform(string_split({s}, ','), lambda q: trim(q)), "
        f"lambda acc, p: CASE WHEN acc.n + {l} + 1 <= {max_words} THEN {fit} ELSE {flush} END, {init})"
    )


def chunk_pieces_cte(src: str, key: str, text_expr: str, carry_bug: bool = False, max_words: int = 128) -> str:
    """CTEs ending in ``pieces(key, i, j, piece)``: the re-packed sentences in order."""
    return f"""
_c AS (SELECT {key} AS k, {text_expr} AS t FROM {src}),
_s AS (SELECT k, {sentences('t')} AS ss FROM _c),
_u AS (SELECT k, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM _s),
_p AS (SELECT k, i, s, CASE WHEN {nw('s')} <= {max_words} THEN NULL ELSE {pack_struct('s', max_words, carry_bug)} END AS r FROM _u),
_q AS (SELECT k, i, CASE WHEN r IS NULL THEN [s]
        ELSE list_concat(r.out, CASE WHEN r.temp <> '' THEN [r.temp] ELSE []::VARCHAR[] END) END AS ps FROM _p),
pieces AS (SELECT k, i, unnest(ps) AS piece, generate_subscripts(ps, 1) AS j FROM _q)
"""


def chunked_text_sql(src: str, key: str, text_expr: str, out_key: str, out_col: str, carry_bug: bool = False) -> str:
    """Query: ``out_key, out_col`` = re-packed text (pieces joined with '. ')."""
    return f"""WITH {chunk_pieces_cte(src, key, text_expr, carry_bug)},
_j AS (SELECT k, string_agg(piece || '. ', '' ORDER BY i, j) AS txt FROM pieces GROUP BY k)
SELECT _c.k AS {out_key}, coalesce(_j.txt, '') AS {out_col} FROM _c LEFT JOIN _j ON _c.k = _j.k"""


def clean_c(x_src: str, key: str, col: str, out_key: str, out_col: str, carry_bug: bool = False) -> str:
    return chunked_text_sql(x_src, key, clean_c_text(col), out_key, out_col, carry_bug)


def clean_d(x_src: str, key: str, col: str, out_key: str, out_col: str, carry_bug: bool = False) -> str:
    return chunked_text_sql(x_src, key, clean_d_text(col), out_key, out_col, carry_bug)


# -- the documents adaptor -------------------------------------------------
def first_line(x: str) -> str:
    return f"split_part({x}, chr(10), 1)"


def articles_view(summary: str = "empty") -> str:
    summ = "''" if summary == "empty" else first_line("text")
    return (
        "SELECT doc_id, 'doc://' || CAST(doc_id AS VARCHAR) AS url, "
        f"{first_line('text')} AS title, {summ} AS summary, text AS content, "
        "CAST(NULL AS VARCHAR) AS pub_date, lang AS category, source, CAST(NULL AS VARCHAR) AS scraped_at "
        "FROM documents"
    )


def md5_key(key: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def split_case(pos: str, n: str) -> str:
    return (
        f"CASE WHEN {pos} <= floor(0.7::DOUBLE * {n}) THEN 'train' "
        f"WHEN {pos} <= floor(0.85::DOUBLE * {n}) THEN 'validation' ELSE 'test' END"
    )


# -- HTML: the expected rules, stated for SQL on their own ---------------------
def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def html_noise(x: str) -> str:
    """Without script and style elements and comments."""
    for pat in (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->"):
        x = rr(nz(x) if "regexp" not in x else x, pat, "")
    return x


#: character reference -> character; the ampersand last
REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "#39": "'", "apos": "'", "nbsp": " ", "copy": "©", "middot": "·",
              "ndash": "–", "mdash": "—", "hellip": "…", "amp": "&"}


def decode_references(x: str) -> str:
    for name, ch in REFERENCES.items():
        x = f"replace({x}, '&{name};', {lit(ch)})"
    return x


def inner_text(x: str) -> str:
    return decode_references(rr(x, "(?s)<[^>]*>", ""))


def element_inner(x: str, tag: str, cls: str | None = None) -> str:
    """Inner HTML of the first such element (of a kind that does not nest in itself on the test pages)."""
    has = f' class="{cls}"' if cls else "[^>]*"
    return f"regexp_extract({x}, '(?is)<{tag}{has}>(.*?)</{tag}>', 1)"


def element_text_or_null(x: str, tag: str, cls: str | None = None) -> str:
    return f"CASE WHEN {x} LIKE '%<{tag}%</{tag}>%' THEN {py_strip(inner_text(element_inner(x, tag, cls)))} END"


def hrefs(fragment: str) -> str:
    """The test pages quote every href with double quotes."""
    return f"list_transform(regexp_extract_all({fragment}, '<a href=\"([^\"]*)\"', 1), lambda h: {decode_references('h')})"


def paragraphs(fragment: str) -> str:
    segs = f"string_split({fragment}, '<p>')"
    body = f"list_transform({segs}[2:], lambda s: split_part(s, '</p>', 1))"
    texts = f"list_transform({body}, lambda s: {py_strip(inner_text('s'))})"
    return f"array_to_string(list_filter({texts}, lambda s: s <> ''), chr(10))"


def page_base(url: str) -> str:
    return f"split_part({url}, '://', 1) || '://' || regexp_extract(split_part({url}, '://', 2), '^[^/?#]*')"


def absolutize(h: str, base: str) -> str:
    return (f"CASE WHEN starts_with({h}, 'http') THEN {h} WHEN starts_with({h}, '/') THEN {base} || {h} "
            f"ELSE {base} || '/' || {h} END")


def page_source(url: str) -> str:
    host = f"regexp_extract(split_part({url}, '://', 2), '^[^/?#:]*')"
    return f"CASE WHEN starts_with({host}, 'www.') THEN substr({host}, 5) ELSE {host} END"


def page_category(url: str) -> str:
    return f"regexp_extract(split_part({url}, '://', 2), '^[^/?#]*/([^/?#]*)', 1)"
