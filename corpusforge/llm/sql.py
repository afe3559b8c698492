"""DuckDB SQL for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

#: Trims the white space that op6 names from both ends of a line.
STRIP = r"regexp_replace({x}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
WITH lines AS (
  SELECT doc_id, u.i AS i, u.line AS line, {LOWER.format(x=STRIP.format(x='u.line'))} AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents) d,
       LATERAL (SELECT unnest(d.a) AS line, generate_subscripts(d.a, 1) AS i) u
), keys AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (keys.k IS NOT NULL AND l.doc_id <> owner) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keys.k IS NULL OR l.doc_id = owner), '')) AS kept_sha256
FROM lines l LEFT JOIN keys ON l.k = keys.k
GROUP BY l.doc_id
"""

OP2 = rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5(concat_ws(':', 'mix-1', doc_id::VARCHAR, md5(text))) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM docs GROUP BY source
), level AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rest,
         sum(w) OVER (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM sources
), clamp AS (
  SELECT *, bool_and(w * rest / free > 3 * source_size) OVER (ORDER BY source_size / w::DOUBLE, source NULLS LAST) AS over_cap FROM level
), filled AS (
  SELECT *, (SELECT min(struct_pack(free := -free, rest := rest)) FROM clamp WHERE NOT over_cap) AS s FROM clamp
), target AS (
  SELECT source, source_size, CASE WHEN over_cap THEN (3 * source_size)::DOUBLE ELSE w * s.rest / -s.free END AS target FROM filled
), reps AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM target
), placed AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM docs d JOIN reps r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies
FROM (SELECT *, (whole + (2 * before + size <= 2 * need)::INT)::BIGINT AS copies FROM placed)
"""


def _op9() -> str:
    limits = {5: 20, 6: 20, 7: 18, 8: 18, 9: 16, 10: 16}
    grams = ",\n".join(
        f"CASE WHEN lead(w, {n - 1}) OVER p IS NOT NULL THEN concat_ws(' ', w, {', '.join(f'lead(w, {k}) OVER p' for k in range(1, n))}) END AS g{n}" for n in limits)
    twice = ", ".join(f"(g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1) AS t{n}" for n in limits)
    inside = ", ".join(
        f"coalesce(bool_or(t{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), false) AS c{n}" for n in limits)
    covered = ", ".join(f"coalesce(sum(length(w)) FILTER (c{n}), 0) AS x{n}" for n in limits)
    verdict = " AND ".join(f"100 * x{n} <= {limit} * word_chars" for n, limit in limits.items())
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, u.w AS w, u.i AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS a FROM docs) d,
       LATERAL (SELECT unnest(d.a) AS w, generate_subscripts(d.a, 1) AS i) u
), grams AS (SELECT doc_id, w, i, {grams} FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, w, i, {twice} FROM grams),
inside AS (SELECT doc_id, w, {inside} FROM twice),
per_doc AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (c5) AS n_repeat_words, {covered} FROM inside GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, count(*) - 1 AS again, list_sum(list_transform(regexp_extract_all(line, '{WORD}'), lambda x: length(x))) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line
), per_line AS (SELECT doc_id, sum(again) AS n_dup_lines, sum(again * chars) AS dup_chars FROM lines GROUP BY doc_id),
base AS (
  SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(dup_chars, 0) AS dup_chars, {', '.join(f'coalesce(x{n}, 0) AS x{n}' for n in limits)}
  FROM docs d LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_line USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND 100 * dup_chars <= 30 * word_chars AND {verdict} AS kept
FROM base
"""


#: Number, in the eight-digit base-32 groups of a hexadecimal SHA-1, of each character.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::INT >> {15 - 5 * k}) & 31) + 1, 1)"
    for g in range(8) for k in range(4))

OP10 = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS error
FROM q
"""

_ESCAPED = r"replace(replace(replace({x}, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>')"

OP4 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), f AS (
  SELECT *, length({_ESCAPED.format(x="text")}) + length(role) + length('### : </turn>') + 1 AS n FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
), least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON node = e.vec_id
"""

#: CRC-32 of the bytes of a text: a register over its hexadecimal digits, two by two, with the table made by rule.
CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(range(8), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, b))"
CRC32 = """xor(4294967295, list_reduce(list_transform(range(1, strlen({x}) + 1), lambda i: ('0x' || substr(hex(encode({x})), 2 * i - 1, 2))::BIGINT),
  lambda r, byte: xor(r >> 8, crc[xor(r, byte) % 256 + 1]), 4294967295))"""

OP11 = rf"""
WITH crc_table AS MATERIALIZED (SELECT {CRC_TABLE} AS crc),
texts AS (
  SELECT 'd' AS corpus, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), split AS (
  SELECT row_number() OVER () AS row, corpus, id, regexp_extract_all({LOWER.format(x="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), features AS (
  SELECT row, corpus, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM split
), held AS (
  SELECT row, corpus, f, count(*) AS n FROM features GROUP BY ALL
), bucket_of AS (
  SELECT f, {CRC32.format(x="f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM held), crc_table
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (corpus = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (corpus = 'b'), 0)::BIGINT AS t FROM held JOIN bucket_of USING (f) GROUP BY bucket
), total AS (SELECT coalesce(sum(s), 0)::BIGINT AS s, coalesce(sum(t), 0)::BIGINT AS t FROM buckets),
gain AS (
  SELECT bucket, floor(1000 * ln(((b.t + 1) * (total.s + 10000))::DOUBLE / ((b.s + 1) * (total.t + 10000))::DOUBLE))::BIGINT AS g FROM buckets b, total
), scores AS (
  SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM held JOIN bucket_of USING (f) JOIN gain USING (bucket) WHERE corpus = 'd' GROUP BY row
), scored AS (
  SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS asked,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN scores USING (row) WHERE corpus = 'd'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY asked) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN asked AND place <= 25 * n // 100 THEN place END AS rank FROM placed
"""

OP12 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id::VARCHAR) AS h FROM documents
), k AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), parts AS (
  SELECT *, substr(text, 1, least(a, b)) AS prefix, substr(text, least(a, b) + 1, abs(a - b)) AS middle, substr(text, greatest(a, b) + 1) AS suffix FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {"op2_mix_sources": OP2, "op4_chat_prefix_trees": OP4, "op5_embedding_dedup": OP5, "op6_line_dedup": OP6, "op9_quality_rules": _op9(),
           "op10_warc_zstd": OP10, "op11_importance_resample": OP11, "op12_fill_in_middle": OP12}
