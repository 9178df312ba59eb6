"""DuckDB SQL of the document queries that SQL can express."""

HOST_QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
g AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
p AS (SELECT rid, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) v(o) GROUP BY rid),
c AS (
  SELECT d.doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(p.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN p USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT host, count(*) AS n, sum(base_failed::INT)::BIGINT AS f FROM b GROUP BY host),
m AS (
  SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(f)::DOUBLE AS f, sum(n::DOUBLE * n) AS nn, sum(f * (f / n)) AS fp FROM h),
q AS (
  SELECT f / n AS mean, fp - f * (f / n) AS spread, (f / n) * (1 - f / n) AS within, n - nn / n - (k - 1) AS room, k
  FROM m),
rho AS (
  SELECT mean, CASE WHEN within > 0 AND room > 0 THEN (spread - within * (k - 1)) / (within * room) ELSE 0 END AS rho
  FROM q),
v AS (
  SELECT host, CASE WHEN rho <= 0 THEN mean
                    ELSE (f + mean * greatest(0, 1 / rho - 1)) / (n + greatest(0, 1 / rho - 1)) END AS rate
  FROM h, rho)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept, b.host, round(rate, 6) AS host_rate
FROM b JOIN v ON b.host IS NOT DISTINCT FROM v.host
"""

EXTENDIBLE_SHARDS = r"""
WITH r AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h,
         octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes
  FROM documents),
s AS (
  SELECT d AS depth, h >> (60 - d) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, min(h) AS lo, max(h) AS hi
  FROM r, range(0, 61) t(d) GROUP BY 1, 2),
leaf AS (
  SELECT * FROM s WHERE (shard_bytes <= 67108864 OR lo = hi)
    AND (depth = 0 OR EXISTS (SELECT 1 FROM s AS u WHERE u.depth = s.depth - 1 AND u.prefix = s.prefix >> 1
                              AND u.shard_bytes > 67108864 AND u.lo <> u.hi)))
SELECT doc_id, n_bytes, depth::INT AS depth, prefix,
       CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 64, '0'), depth::INT) END AS shard,
       shard_bytes, shard_bytes > 67108864 AS oversized
FROM r JOIN leaf ON r.h >> (60 - leaf.depth) = leaf.prefix
"""
