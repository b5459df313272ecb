"""DuckDB counterparts of the queries that SQL can express, written from the contracts."""

from __future__ import annotations


def _crc_table() -> str:
    """The table of the reflected CRC-32 polynomial, as a DuckDB list."""
    rows = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        rows.append(value)
    return "[" + ", ".join(f"{row}::UBIGINT" for row in rows) + "]"


SHARDING = f"""
WITH RECURSIVE walk AS (
  SELECT doc_id, CAST(doc_id AS HUGEINT) AS state, CAST(0 AS BIGINT) AS spot, CAST(0 AS BIGINT) AS next
  FROM documents
  UNION ALL
  SELECT doc_id, s, next,
         CAST(floor(CAST(next + 1 AS DOUBLE)
              * (2147483648.0::DOUBLE / CAST(s // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, next,
               (state * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS s
        FROM walk WHERE next < 17)
), placed AS (
  SELECT doc_id, CAST(max(spot) FILTER (WHERE spot < 16) AS INTEGER) AS shard,
         CAST(max(spot) AS INTEGER) AS grown_shard
  FROM walk GROUP BY doc_id
), bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         list_transform(
           list_filter(string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'), ' '),
                       lambda h: h <> ''),
           lambda h: CAST('0x' || h AS UBIGINT)) AS b,
         (CAST(doc_id AS HUGEINT) * 2862933555777941757::HUGEINT + 1)
           % 18446744073709551616::HUGEINT // 8589934592 % 256 AS block
  FROM documents
), sums AS (
  SELECT doc_id, size, block,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, b),
             lambda c, x: xor(c >> 8, {_crc_table()}[CAST(1 + (xor(c, x) & 255) AS BIGINT)])), 4294967295::UBIGINT) AS crc
  FROM bytes
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, CAST(s.crc AS BIGINT) AS text_crc32, 'key' AS law, p.shard,
       row_number() OVER (PARTITION BY p.shard ORDER BY s.block, s.doc_id) - 1 AS slot, p.grown_shard
FROM sums s JOIN placed p ON s.doc_id = p.doc_id
"""

EXACT_DEDUP = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY content) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY content) AS kept,
       sha256(content) AS text_sha256
FROM t
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
  SELECT doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50
), windows AS (
  SELECT doc_id, i,
         min(doc_id) OVER (PARTITION BY array_to_string(list_slice(w, i, i + 49), ' ')) < doc_id AS later
  FROM starts
), positions AS (
  SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), marked AS (
  SELECT p.doc_id, p.word, p.i,
         coalesce(max(CAST(later AS INTEGER)) OVER (
           PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM positions p LEFT JOIN windows s ON p.doc_id = s.doc_id AND p.i = s.i
), kept AS (
  SELECT doc_id, sum(gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT d.doc_id, d.line, d.i, coalesce(c.last > d.doc_id, false) AS gone
  FROM keyed d LEFT JOIN common c ON d.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL_SEARCH = f"""
WITH tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL
), lengths AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tfs, corpus GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), scored AS (
  SELECT item_id, t.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked a JOIN tfs t ON a.term = t.term JOIN weights g ON a.term = g.term
       JOIN lengths l ON t.doc_id = l.doc_id, corpus
  GROUP BY item_id, t.doc_id
), ranks AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50
"""

SQL = {
    "op12_lexical_search": LEXICAL_SEARCH,
    "op2_sharding": SHARDING,
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op3_line_dedup": LINE_DEDUP,
    "op5_exact_dedup": EXACT_DEDUP,
}
