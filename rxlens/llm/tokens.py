"""Token counts of parts of documents, from one encoding of the whole document.

A document is encoded once. Its tokens lie end to end over its bytes, so their spans are sorted
intervals, as are the sections (lines that are not blank), and both are joined by a merge of
their bounds. A token that crosses from one section into the next, or into the space between,
belongs to the section that holds most of its bytes, of equals the earlier one; a token with no
byte in any section counts as ``between``. So each token is counted once, and the
counts of a document add up to its tokens.

The vocabulary is a public rank file at ``ranks_path``, read once per task.

Defined results: a null or empty text has no tokens and no sections; a text of blank lines has
tokens, but no section; rows that repeat are counted each; fields (other string columns) are
encoded one by one if asked for, a null one has no tokens. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import batch_of, plain_texts
from rxlens.llm.bpe import read_ranks

_SECTION = re.compile(rb"[^\n]*[^ \t\r\x0b\x0c\n][^\n]*")


def sections(text: bytes) -> np.ndarray:
    """Bounds (start, end) of the lines that are not blank, without their line ends."""
    found = [m.span() for m in _SECTION.finditer(text)]
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def allocate(token_ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The section of each token, -1 for none, by the rule above.

    ``token_ends`` are the ends of tokens that lie end to end from 0.
    """
    starts = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    best = np.full(len(token_ends), -1, dtype=np.int64)
    most = np.zeros(len(token_ends), dtype=np.int64)
    if not len(bounds) or not len(token_ends):
        return best
    # Sections that a token meets are consecutive: from the first that ends after the token's
    # start to the last that starts before its end.
    first = np.searchsorted(bounds[:, 1], starts, side="right")
    last = np.searchsorted(bounds[:, 0], token_ends, side="left")
    for step in range(int((last - first).max(initial=0))):
        at = first + step
        on = at < last
        section = bounds[np.minimum(at, len(bounds) - 1)]
        inside = np.minimum(token_ends, section[:, 1]) - np.maximum(starts, section[:, 0])
        better = on & (inside > most)
        best[better], most[better] = at[better], inside[better]
    return best


class Counter:
    """Encodes whole texts and knows where their tokens end."""

    def __init__(self, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def token_ends(self, text: str) -> np.ndarray:
        ids = self.encoding.encode_ordinary(text)
        return np.cumsum(self.lengths[np.array(ids, dtype=np.int64)])


_COUNTS = (
    "doc_id long, n_tokens long, n_sections long, section_tokens array<long>, "
    "between_tokens long, n_crossing long"
)


def count_sections(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: its tokens, tokens per section, tokens between, tokens that cross."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(ranks_path, pattern)
            rows = []
            pairs = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            for doc_id, text in pairs:
                ends = counter.token_ends(text)
                bounds = sections(text.encode())
                section = allocate(ends, bounds)
                each = np.bincount(section[section >= 0], minlength=len(bounds)).tolist()
                inner = np.unique(bounds)
                inner = inner[(inner > 0) & (inner < (ends[-1] if len(ends) else 0))]
                crossing = int((~np.isin(inner, ends)).sum())
                row = (len(ends), len(bounds), each, int((section < 0).sum()), crossing)
                rows.append((doc_id, *row))
            yield batch_of(rows, _COUNTS)

    return plain_texts(docs).mapInArrow(run, _COUNTS)


def count_fields(
    docs: DataFrame, fields: list[str], ranks_path: str, pattern: str, joint: str = "\n"
) -> DataFrame:
    """Per document: tokens of each field, when the fields are encoded as one whole.

    Fields are joined by ``joint``, whose tokens count with the field before them; a token
    that crosses a bound goes by the rule of sections.
    """
    schema = "doc_id long, n_tokens long, field_tokens array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(ranks_path, pattern)
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(1, len(fields) + 1)]
            for doc_id, *values in zip(batch.column(0).to_pylist(), *columns):
                parts = [v + joint for v in values[:-1]] + values[-1:]
                stops = np.cumsum([len(p.encode()) for p in parts])
                bounds = np.stack([stops - [len(p.encode()) for p in parts], stops], axis=1)
                ends = counter.token_ends("".join(parts))
                section = allocate(ends, bounds)
                each = np.bincount(section[section >= 0], minlength=len(parts)).tolist()
                rows.append((doc_id, len(ends), each))
            yield batch_of(rows, schema)

    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    named = [t.alias(f"f{i}") for i, t in enumerate(texts)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *named).mapInArrow(run, schema)
