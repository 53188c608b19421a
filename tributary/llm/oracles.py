"""DuckDB SQL for the queries that SQL can express."""

ESCAPED = "replace(replace({0}, '&', '&amp;'), '<|', '&lt;|')"

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: floor(256 * x) of usable vectors, as longs.
QUANTIZED = """
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

#: Unsigned crc32 of a bigint column's decimal digits: bit by bit over its bytes.
CRC32 = """xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(8 * length({0}::VARCHAR)), lambda i: CASE WHEN i % 8 = 0 THEN (256 + ascii(substr({0}::VARCHAR, CAST(i // 8 + 1 AS INT), 1)))::UBIGINT ELSE 0::UBIGINT END)),
    lambda c, b: CASE WHEN xor(c, b & 255) & 1 = 1 THEN xor(xor(c, b & 255) >> 1, 3988292384::UBIGINT) ELSE xor(c, b & 255) >> 1 END), 4294967295::UBIGINT)"""

ORACLES = {
    "op4_warc_index": f"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}',
           CAST((CAST('0x' || substr(h, CAST(10 * (i // 8) + 1 AS INT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
""",
    "op8_pivot_top_k": f"""
WITH q AS ({QUANTIZED}), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
    FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op10_chat_format": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked AS (
    SELECT *, 12 + length(replace({ESCAPED.format('role')}, chr(10), '&nl;')) + 1 + length({ESCAPED.format('text')}) + 11 AS chars,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           count(*) OVER (PARTITION BY conv_id) AS turns_of
    FROM turns
), grown AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM marked
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(so_far) FILTER (role = 'assistant' OR place = turns_of) AS BIGINT) AS formatted_chars
FROM grown GROUP BY conv_id
""",
    "op12_prefix_trie": f"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 20 AS base, CAST({CRC32.format("c")} AS BIGINT) % 4 AS heads FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
    SELECT convs.c, 0 AS part, place, role, text FROM convs JOIN turns ON turns.c = base AND place <= heads
    UNION ALL
    SELECT convs.c, 1, place, role, text FROM convs JOIN turns ON turns.c = convs.c AND place > heads
), ordered AS (
    SELECT c, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           string_agg(sha256(role || chr(0) || text), '') OVER w AS key
    FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, place)
), prefixes AS (
    SELECT c, depth, words, key, depth = max(depth) OVER (PARTITION BY c) AS ends FROM (
        SELECT * FROM ordered UNION ALL SELECT c, 0, 0, '' FROM convs)
), nodes AS (
    SELECT key, depth, min(c) AS c, count(*) AS n, max(words) AS words,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY key, depth
), linked AS (
    SELECT nodes.*, p.key AS parent, p.c AS parent_c FROM nodes LEFT JOIN nodes p
    ON nodes.depth > 0 AND p.depth = nodes.depth - 1 AND p.key = left(nodes.key, len(nodes.key) - 64)
), kids AS (
    SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY ALL
), sums AS (
    SELECT a.key, a.depth, sum((y.n - 1) * y.words) AS saved, count(*) FILTER (k.n_children IS NULL) AS leaves
    FROM nodes y JOIN prefixes a ON a.c = y.c AND a.depth <= y.depth
    LEFT JOIN kids k ON k.parent = y.key AND k.depth = y.depth GROUP BY ALL
)
SELECT c AS conv_id, depth, parent_c AS parent_conv_id, n AS n_convs, coalesce(n_children, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (key, depth) LEFT JOIN kids ON kids.parent = linked.key AND kids.depth = linked.depth
""",
}
