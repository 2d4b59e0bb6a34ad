"""DuckDB SQL for the operator queries that SQL can state exactly."""

#: Words are what ASCII white space leaves; a window is named by its words joined by one space.
SUBSTRING = r"""
WITH words AS (
  SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i : i + 12], ' '))) AS win FROM words WHERE len(w) >= 13
), firsts AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY win) AS first FROM windows
), covered AS (
  SELECT doc_id, list(DISTINCT k) AS gone FROM (SELECT doc_id, unnest(range(pos, pos + 13)) AS k FROM firsts WHERE first < doc_id) GROUP BY doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
         ELSE array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(gone, k)), lambda k: w[k]), ' ') END) AS kept_sha256
FROM words LEFT JOIN covered USING (doc_id)
"""

EXACT_TOPK = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM rows q, rows r WHERE q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

#: Base32 of the 160 bits, five at a time.
WARC = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), last AS (
  SELECT hex, max(page_id) AS response FROM sized GROUP BY hex
)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(5), lambda j: substr(unhex(hex)::BIT::VARCHAR, (5 * i + j + 1)::INT, 1)::INT * (1 << (4 - j))))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM sized JOIN last USING (hex)
"""

#: CRC-32 runs over the bytes of the decimal id with a table of 256 remainders, made by its rule.
TRIE = """
WITH bytes AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b::BIGINT] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc
), turns AS (
  SELECT conv_id, coalesce(text, '') AS said, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, x: xor(c // 256, crc[(xor(c, x) % 256 + 1)::INT])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), bytes
), rebuilt AS (
  SELECT conv_id, said, t, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM (
    SELECT c.conv_id, 0 AS own, pos, said, t FROM convs c JOIN turns ON turns.conv_id = c.base WHERE pos <= h
    UNION ALL SELECT c.conv_id, 1, pos, said, t FROM convs c JOIN turns ON turns.conv_id = c.conv_id WHERE pos > h)
), prefixes AS (
  SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS chars FROM convs
  UNION ALL
  SELECT conv_id, depth, node, CASE WHEN depth = 1 THEN '' ELSE lag(node) OVER (PARTITION BY conv_id ORDER BY depth) END, chars FROM (
    SELECT conv_id, depth, length(said) AS chars, md5(string_agg(t, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM rebuilt)
), sized AS (
  SELECT *, max(depth) OVER (PARTITION BY conv_id) AS len FROM prefixes
), nodes AS (
  SELECT node, depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256
  FROM sized GROUP BY node, depth
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1
), sums AS (
  SELECT up.node, up.depth, count(*) FILTER (NOT EXISTS (FROM children c WHERE c.node = n.node)) AS n_leaves, sum((n_convs - 1) * n.chars) AS saved_tokens
  FROM nodes n JOIN prefixes up ON up.conv_id = n.conv_id AND up.depth <= n.depth GROUP BY 1, 2
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.depth = n.depth
LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
"""

ORACLE_SQL = {"op1_substring": SUBSTRING, "op5_exact_topk": EXACT_TOPK, "op7_warc": WARC, "op13_prefix_trie": TRIE}
