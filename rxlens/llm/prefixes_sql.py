"""The trie's rows in SQL: every conversation's prefixes as digests of their turns."""

from __future__ import annotations

from rxlens.llm.manifest_sql import CRC_TABLE, crc_of

TRIE_SQL = f"""
WITH {CRC_TABLE},
texts AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, id, length(text) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos
  FROM texts),
convs AS (
  SELECT conv_id, {crc_of("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS base
  FROM (SELECT DISTINCT conv_id FROM own), crc_table),
rebuilt AS (
  SELECT c.conv_id, pos, id, chars FROM convs c JOIN own o ON o.conv_id = c.base AND pos <= h
  UNION ALL
  SELECT c.conv_id, pos, id, chars FROM convs c JOIN own o ON o.conv_id = c.conv_id AND pos > h),
steps AS (
  SELECT conv_id, chars, row_number() OVER w AS depth, list(id) OVER w AS ids
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
path AS (
  SELECT conv_id, 0 AS depth, 0 AS chars, '' AS k FROM convs
  UNION ALL SELECT conv_id, depth, chars, sha256(array_to_string(ids, ',')) FROM steps),
lengths AS (SELECT conv_id, max(depth) AS n FROM path GROUP BY conv_id),
nodes AS (
  SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth) AS ends
  FROM path JOIN lengths USING (conv_id) GROUP BY depth, k),
links AS (
  SELECT c.depth, c.k, u.conv_id AS parent_conv_id, p.k AS pk
  FROM nodes c JOIN path p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1
  JOIN nodes u ON u.depth = p.depth AND u.k = p.k),
children AS (SELECT depth - 1 AS depth, pk AS k, count(*) AS n FROM links GROUP BY ALL),
below AS (
  SELECT p.depth, p.k, count(*) FILTER (c.n IS NULL) AS n_leaves,
         sum((u.n_convs - 1) * u.chars) AS saved
  FROM nodes u JOIN path p ON p.conv_id = u.conv_id AND p.depth <= u.depth
  LEFT JOIN children c ON c.depth = u.depth AND c.k = u.k GROUP BY p.depth, p.k)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, l.parent_conv_id, v.n_convs,
       coalesce(c.n, 0) AS n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes v JOIN below b USING (depth, k) LEFT JOIN links l USING (depth, k)
LEFT JOIN children c USING (depth, k)
"""
