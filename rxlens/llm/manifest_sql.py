"""The manifest's rows in SQL, and a CRC-32 of decimal numbers for any query."""

from __future__ import annotations

#: One row: the CRC-32 table, as a list.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i)))
"""


def crc_of(number: str) -> str:
    """CRC-32 of a number written in decimal; ``crc_table`` must be in scope."""
    return f"""xor(4294967295, list_reduce(
      [4294967295] || list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])))"""


def _encoded(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(_encoded(v) for v in values) + ")"


_UP = """
  SELECT tree, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM {0} WHERE n > 1 GROUP BY tree, lvl, idx // 8, n"""

_RUNS = """
  SELECT tree, lvl, idx // 8 AS run, list(h ORDER BY idx) AS hs
  FROM {0} WHERE n > 1 GROUP BY tree, lvl, idx // 8"""

_WALK = """
  SELECT w.r, w.tree, w.lvl + 1, w.idx // 8, (w.n + 7) // 8,
         sha256(coalesce(array_to_string(hs[1:w.idx % 8], ''), '') || w.h
                || coalesce(array_to_string(hs[w.idx % 8 + 2:], ''), '')),
         w.proof || coalesce(array_to_string(hs[1:w.idx % 8], ''), '')
                 || coalesce(array_to_string(hs[w.idx % 8 + 2:], ''), '')
  FROM {0} w JOIN {1} s ON s.tree = w.tree AND s.lvl = w.lvl AND s.run = w.idx // 8
  WHERE w.n > 1"""

MANIFEST_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree,
         {_leaf("text")} AS leaf,
         CASE WHEN {crc_of("doc_id")} % 3 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_leaf("text")} END AS read
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n
  FROM d),
up(tree, lvl, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM leaves UNION ALL {_UP.format("up")}),
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
  FROM up WHERE n = 1),
over(tree, lvl, idx, n, h) AS (
  SELECT '', 0, idx, n, h FROM subroots UNION ALL {_UP.format("over")}),
runs AS ({_RUNS.format("up")}),
over_runs AS ({_RUNS.format("over")}),
walk(r, tree, lvl, idx, n, h, proof) AS (
  SELECT r, tree, 0, idx, n, read, '' FROM leaves UNION ALL {_WALK.format("walk", "runs")}),
rise(r, tree, lvl, idx, n, h, proof) AS (
  SELECT w.r, '', 0, s.idx, s.n, w.h, w.proof
  FROM walk w JOIN subroots s ON s.tree = w.tree WHERE w.n = 1
  UNION ALL {_WALK.format("rise", "over_runs")})
SELECT l.doc_id, l.leaf, s.h AS subroot, o.h AS root, sha256(e.proof) AS proof_sha256,
       e.h AS folded_root, e.h = o.h AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree
JOIN (SELECT h FROM over WHERE n = 1) o ON true
JOIN rise e ON e.r = l.r AND e.n = 1
"""
