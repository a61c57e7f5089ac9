"""A training corpus from raw documents: filter, deduplicate, decontaminate, encode.

Each stage calls one operator and returns the documents it keeps with the columns of
``documents``; the last returns token ids. Stages are written as Parquet and read again, so a
lost executor costs no earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rxlens.llm import bpe, decontam, repeats, simhash, toxicity
from rxlens.llm.registry import table
from rxlens.operators.reuse import checkpoint_stage

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur twice are cut out of all texts."""
    return repeats.drop_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left; each row's ids are decoded and must give its text again."""
    return bpe.encode_checked(docs, RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode_tokens),
]

#: A classifier, a fingerprint's components and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` to token ids."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint_stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
