"""Queries of the operators once more, as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _reached(edges: str, vertices: str) -> str:
    """reached(v, least): the least vertex that can be reached. Edges stand in both directions."""
    return f"""
walked AS (
  SELECT v, v AS w FROM {vertices}
  UNION
  SELECT walked.v, {edges}.b AS w FROM walked JOIN {edges} ON {edges}.a = walked.w
),
reached AS (SELECT v, min(w) AS least FROM walked GROUP BY v)"""


MINHASH = rf"""
WITH RECURSIVE numbered AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words,
    row_number() OVER () AS r
  FROM documents
),
shingled AS (
  SELECT doc_id, r, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i : i + 2])) END
    AS shingles
  FROM numbered
),
each AS (SELECT r, doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM shingled),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS m, y.n AS n, count(*) AS c
  FROM each x JOIN each y ON x.shingle = y.shingle AND x.r <> y.r
    AND 100 * x.n >= 85 * y.n AND 100 * y.n >= 85 * x.n
  GROUP BY x.r, y.r, x.doc_id, y.doc_id, x.n, y.n
),
edges AS (SELECT DISTINCT a, b FROM shared WHERE 100 * c >= 85 * (m + n - c) AND a <> b),
vertices AS (SELECT DISTINCT doc_id AS v FROM numbered WHERE doc_id IS NOT NULL),
{_reached("edges", "vertices")}
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least AS component_id,
  coalesce(doc_id = least, false) AS kept
FROM shingled LEFT JOIN reached ON v = doc_id
"""

DECONTAMINATE = rf"""
WITH numbered AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size, words[k : k + 9] AS part
  FROM items, unnest(range(1, greatest(2, len(words) - 8))) AS t(k)
  WHERE len(words) > 0
),
places AS (
  SELECT r, k, size, words[k : k + size - 1] AS part
  FROM numbered, (SELECT DISTINCT size FROM windows), unnest(range(1, len(words) - size + 2)) AS t(k)
),
hits AS (SELECT r, k, size, item_id FROM places JOIN windows USING (size, part)),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM hits, unnest(range(k, k + size)) AS t(p) GROUP BY r
),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
  GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM numbered LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

EMBEDDINGS = f"""
WITH RECURSIVE numbered AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, row_number() OVER () AS r
  FROM embeddings
),
usable AS (
  SELECT vec_id, label, x, r, sqrt(list_dot_product(x, x)) AS size FROM numbered
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(x) > 0
    AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(x, lambda y: y <> 0)) > 0
),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b, p.r FROM usable p JOIN usable q
    ON p.label = q.label AND len(p.x) = len(q.x) AND p.r <> q.r
    AND list_dot_product(p.x, q.x) >= 0.93 * p.size * q.size
),
counted AS (SELECT r, count(*) AS n FROM links GROUP BY r),
edges AS (SELECT DISTINCT a, b FROM links WHERE a <> b),
vertices AS (SELECT DISTINCT vec_id AS v FROM numbered WHERE vec_id IS NOT NULL),
{_reached("edges", "vertices")}
SELECT vec_id, coalesce(n, 0) AS n_links, least AS component_id,
  coalesce(vec_id = least, false) AS kept
FROM numbered LEFT JOIN counted USING (r) LEFT JOIN reached ON v = vec_id
"""

# Base32 writes 20 bits, five hexadecimal digits, as four letters.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least
  FROM pages
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: '{_LETTERS}'[1 +
    ((CAST('0x' || hex[1 + 5 * (i // 4) : 5 + 5 * (i // 4)] AS BIGINT) >> (15 - 5 * (i % 4))) & 31)]),
    'string_agg', '') AS payload_digest,
  CASE WHEN least IS NULL OR page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN least IS NOT NULL AND page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM payloads
"""

# CRC-32 byte by byte; its table is made by the rule of the polynomial.
RESAMPLING = rf"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS bytes(i))
),
numbered AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
items AS (
  SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
),
features AS (
  SELECT r, array_to_string(words[k : k + n - 1], ' ') AS feature
  FROM numbered, unnest([1, 2, 3]) AS sizes(n), unnest(range(1, len(words) - n + 2)) AS t(k)
),
wanted AS (
  SELECT array_to_string(words[k : k + n - 1], ' ') AS feature
  FROM items, unnest([1, 2, 3]) AS sizes(n), unnest(range(1, len(words) - n + 2)) AS t(k)
),
buckets AS (
  SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      range(strlen(feature)), lambda k: CAST('0x' || code[2 * k + 1 : 2 * k + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)]))) % 10000 AS bucket
  FROM (
    SELECT feature, hex(encode(feature)) AS code
    FROM (SELECT feature FROM features UNION SELECT feature FROM wanted)
  ), crc_table
),
s AS (SELECT bucket, count(*) AS n FROM features JOIN buckets USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (feature) GROUP BY bucket),
totals AS (
  SELECT CAST(coalesce((SELECT sum(n) FROM s), 0) AS DOUBLE) AS all_s,
    CAST(coalesce((SELECT sum(n) FROM t), 0) AS DOUBLE) AS all_t
),
gains AS (
  SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * (all_s + 10000)
    / ((s.n + 1.0::DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON t.bucket = s.bucket, totals
),
weights AS (
  SELECT r, count(*) AS n_features, sum(gain) AS weight
  FROM features JOIN buckets USING (feature) JOIN gains USING (bucket) GROUP BY r
),
scored AS (
  SELECT doc_id, len(words) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' ||
      sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM numbered LEFT JOIN weights USING (r)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20
    ORDER BY score DESC, doc_id ASC NULLS LAST, n_features) AS place FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND
  place <= 5 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN place END AS rank
FROM ranked
"""


def _lloyd(rounds: int) -> str:
    """book0 … book<rounds>: part, entry and components of each codebook."""
    steps = []
    for k in range(rounds):
        steps.append(f"""
near{k} AS (
  SELECT r, p, x, arg_min(entry, d * 256 + entry) AS entry, min(d) AS d FROM (
    SELECT r, parts.p, parts.x, entry,
      list_sum(list_transform(list_zip(parts.x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN book{k} USING (p)
  ) GROUP BY r, p, x
)""")
        if k + 1 < rounds:
            steps.append(f"""
mean{k} AS (
  SELECT p, entry, list(m ORDER BY i) AS c FROM (
    SELECT p, entry, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM near{k}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY p, entry, i
  ) GROUP BY p, entry
),
book{k + 1} AS (
  SELECT p, entry, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, entry)
)""")
    return ",".join(steps)


VECTOR_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
    list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * 1024) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
parts AS (
  SELECT r, p, x[p * len(x) // 4 + 1 : (p + 1) * len(x) // 4] AS x FROM kept, range(4) AS t(p)
),
book0 AS (SELECT p, r - 1 AS entry, x AS c FROM parts WHERE r <= 256),
{_lloyd(5)},
codes AS (
  SELECT r, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error
  FROM near4 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) FROM book4)
    AS codebooks_sha256
FROM kept JOIN codes USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": MINHASH,
        "op2_warc": WARC,
        "op3_decontaminate": DECONTAMINATE,
        "op5_embedding_dedup": EMBEDDINGS,
        "op11_resampling": RESAMPLING,
        "op13_vector_codes": VECTOR_CODES,
    }
