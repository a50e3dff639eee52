"""Reference SQL (DuckDB dialect) of the training-data queries that SQL can express.

Written from the result contracts, not from the operators: a sliding window
join instead of fingerprints, pattern cuts instead of a style tree, a byte loop
instead of built-in checksums.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The article of the shared pages, cut at its block tags. Their texts hold three character references.
OP1 = r"""
WITH cut AS (
  SELECT page_id, url, regexp_split_to_array(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:h1|p)>') AS parts FROM pages
), clean AS (
  SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
      '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM cut
)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text,
       CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS n_chars FROM clean
"""

# Jump consistent hashing with 128-bit integers; crc32 byte by byte from its polynomial.
OP3 = r"""
WITH RECURSIVE jumps AS (
  SELECT DISTINCT doc_id AS k, CAST(coalesce(doc_id, 0) AS HUGEINT) + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END AS key,
         CAST(0 AS BIGINT) AS j FROM documents
  UNION ALL
  SELECT k, next, CAST(floor(CAST(j + 1 AS DOUBLE) * (2147483648.0::DOUBLE / CAST(next // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT k, j, (key * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM jumps WHERE j < 17)
), shards AS (
  SELECT k, CAST(max(j) FILTER (WHERE j < 16) AS INTEGER) AS shard, CAST(max(j) FILTER (WHERE j < 17) AS INTEGER) AS grown_shard
  FROM jumps GROUP BY k
), polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), sized AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, polynomial
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32) - 1 AS slot, grown_shard
FROM sized JOIN shards ON doc_id IS NOT DISTINCT FROM k
"""

# Every window of every document against every window of every item.
OP7 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s
        FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT rid, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d JOIN sizes ON len(w) >= n)
), hits AS (SELECT rid, item, n, s FROM doc_windows JOIN item_windows USING (n, win)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
""".replace("LOWERED", _LOWER)

OP8 = r"""
WITH judged AS (
  SELECT d.source, d.lang, d.text, l.quality, l.toxic
  FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic
                              FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
), kept AS (
  -- no token spans lines, so the order of the distinct lines does not matter
  SELECT source, lang, CASE WHEN quality = 0
    THEN array_to_string(list_distinct(string_split(text, chr(10))), chr(10)) ELSE text END AS text
  FROM judged WHERE toxic IS NULL OR toxic <> 1
), counts AS (
  SELECT source, lang, 'words-1' AS tokenizer,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'words-2',
         len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\x0b\f\r]')) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
FROM counts GROUP BY source, lang, tokenizer
"""


def _op11() -> str:
    """Brute force: every part against every entry of its codebook, four rounds written out."""
    steps = []
    for r in range(5):
        steps.append(f"""found{r} AS MATERIALIZED (
  SELECT rid, part, min(d * 256 + entry) % 256 AS entry, min(d * 256 + entry) // 256 AS d
  FROM (SELECT rid, part, entry, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS HUGEINT) AS d
        FROM parts JOIN book{r} USING (part)) GROUP BY rid, part
)""")
        if r < 4:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, c) AS c FROM book{r} LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m
    FROM (SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n
          FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i FROM parts JOIN found{r} USING (rid, part))
          GROUP BY part, entry, i) GROUP BY part, entry) USING (part, entry)
)""")
    return """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), parts AS MATERIALIZED (
  SELECT rid, part, list_slice(v, part * (len(v) // 4) + 1, (part + 1) * (len(v) // 4)) AS x
  FROM (SELECT rid, v, unnest(range(4)) AS part FROM kept)
), book0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, x AS c FROM parts WHERE rid <= 256),
""" + ",\n".join(steps) + """,
named AS (
  SELECT rid, string_agg(lower(lpad(to_hex(CAST(entry AS BIGINT)), 2, '0')), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM found4 GROUP BY rid
), books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN named USING (rid), books
"""


OP11 = _op11()

# Every anchor against every row.
OP12 = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS MATERIALIZED (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])) AS BIGINT) AS score
  FROM kept a, kept r WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT arid, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id NULLS LAST) AS p
  FROM scored WHERE label = anchor_label AND vec_id IS DISTINCT FROM anchor_id QUALIFY p <= 5
)
SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY arid, p ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank
FROM positive JOIN (SELECT arid, vec_id, score, label FROM scored) s USING (arid)
WHERE s.label <> anchor_label AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""
