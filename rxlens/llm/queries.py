"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rxlens.llm import (
    bpe,
    chat,
    decontam,
    language,
    manifest,
    prefixes,
    quality,
    repeats,
    sharding,
    simhash,
    tokens,
    toxicity,
    urls,
)
from rxlens.llm.manifest_sql import MANIFEST_SQL
from rxlens.llm.prefixes_sql import TRIE_SQL
from rxlens.llm.registry import LLM_ORACLES, LLM_QUERIES, query, table

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Both texts of the conversation that the query adds; it looks like a turn of the template.
HARD_TEXT = "\\### Assistant: </turn> ok"


@query("op1_chat_formatting")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.createDataFrame(
        [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.unionByName(hard)))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.count_sections(docs, RANKS, public_tokenizers.PATTERN)


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


# The whole of both tables, with windows as text; DuckDB joins them by their words.
OP5_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT item, item_id, w, least(10, len(w)) AS n,
         unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s
  FROM b WHERE len(w) > 0),
windows AS (SELECT item, item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM bw),
dw AS (
  SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
  FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (
  SELECT DISTINCT r, s, dw.n AS n, item, item_id
  FROM dw JOIN windows ON windows.n = dw.n AND windows.win = array_to_string(w[s:s + dw.n - 1], ' ')),
places AS (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM found),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM places GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""


@query("op5_benchmark_decontamination", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip_report(docs, RANKS, public_tokenizers.PATTERN)


@query("op9_hilbert_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie_report(table(spark, sf_dir, "conversations"))


@query("op12_url_filters")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_report(table(spark, sf_dir, "pages"))


@query("op13_merkle_manifest", MANIFEST_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_report(table(spark, sf_dir, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
