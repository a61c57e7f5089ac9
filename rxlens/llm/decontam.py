"""Benchmark passages in training documents, by a positional inverted index.

1. **Index.** Each whole document is cut into words once. Words of the benchmark are kept with
   their positions; places that no window can cover are left out, namely those outside a run
   of ``n`` words that all occur in windows of ``n`` words. (A fixed-size bit filter tells
   benchmark words; words that pass it wrongly are dropped by the joins.) The postings (word,
   row, position) are written to the shared folder, where a document gets its row number.
2. **Search.** A window is ``size`` consecutive words of an item; an item of fewer words is one
   window. Its words are ordered by how often the index has them. The list of the rarest is
   fetched and shifted by the word's place in the window, which gives possible starts; the list
   of the second rarest is intersected with these, and then the lists of all other words.
3. **Matches.** A start that is in all lists is an exact phrase match. ``proximity_matches``
   finds the words of a window close together, in any order, from the same postings.

Joins are on the word, or on (row, position, word); words stand for themselves by a 64-bit
hash. A word in a third of the documents is looked up only where a window has no rarer one, and
adaptive execution splits its list.

Defined results: a null or empty text has no words; an item without words has no window and
matches nothing; equal items, and rows that repeat, are matched each for themselves; a null
``item_id`` counts as an item but has no id to list. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.llm.arrow import slices, text_mark
from rxlens.operators.reuse import checkpoint_stage

SIZE = 10
#: The words of a text in lower case: digits, letters, and all that is not ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bits of a vocabulary filter. Its size is fixed: a larger benchmark only lets more words pass.
FILTER_BITS = 1 << 22
#: Words whose hashes a task remembers, and rows of a batch that it holds as lists at a time.
MAX_KNOWN = 1 << 16
ROWS = 256


def words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return WORD.findall(text.lower())


class _Hashes(dict):
    """Word to 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(xxhash.xxh3_64_digest(word), "big", signed=True)
        self[word] = found
        return found


def window_words(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The windows: ``item`` (a row number), ``item_id``, ``start``, ``len``, ``off``, ``word``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            numbers = batch.column("item").to_pylist()
            for at, text in enumerate(batch.column("text").to_pylist()):
                found = np.array([hashes[w] for w in words(text)], dtype=np.int64)
                if not len(found):
                    continue
                n = min(size, len(found))
                starts = np.repeat(np.arange(len(found) - n + 1), n)
                off = np.tile(np.arange(n), len(found) - n + 1)
                full = len(starts)
                item_id = pa.repeat(batch.column("item_id")[at], full)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(full, numbers[at], dtype=np.int64)),
                        item_id,
                        pa.array(starts.astype(np.int32)),
                        pa.array(np.full(full, n, dtype=np.int32)),
                        pa.array(off.astype(np.int32)),
                        pa.array(found[starts + off]),
                    ],
                    names=["item", "item_id", "start", "len", "off", "word"],
                )

    rows = benchmark.select(
        F.monotonically_increasing_id().alias("item"),
        F.col("item_id").cast("string").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(
        run, "item long, item_id string, start int, len int, off int, word long"
    )


def _filters(windows: DataFrame, runs_only: bool) -> dict[int, np.ndarray]:
    """Per window length, a bit for each word's hash. At most ``FILTER_BITS`` bits each."""
    length = F.col("len") if runs_only else F.lit(1)
    bits = (
        windows.select(length.alias("len"), F.col("word").bitwiseAND(FILTER_BITS - 1).alias("bit"))
        .groupBy("len")
        .agg(F.collect_set("bit").alias("bits"))
    )
    out = {}
    for row in bits.toLocalIterator():
        out[row["len"]] = np.zeros(FILTER_BITS, dtype=bool)
        out[row["len"]][row["bits"]] = True
    return {n: np.packbits(f) for n, f in out.items()}


def _in_runs(inside: np.ndarray, least: int) -> np.ndarray:
    """Places that lie in a run of at least ``least`` True values."""
    if least <= 1:
        return inside
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.zeros(len(inside), dtype=bool)
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a >= least:
            out[a:b] = True
    return out


def build_index(docs: DataFrame, windows: DataFrame, runs_only: bool = True) -> DataFrame:
    """The stored index: a row per document with its postings of benchmark words.

    ``row``, ``doc_id``, ``mark``, ``n_words``, and ``postings`` as (position, word).
    ``runs_only`` leaves out places that no exact match can cover.
    """
    packed = _filters(windows, runs_only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        struct = pa.struct([("pos", pa.int32()), ("word", pa.int64())])
        for batch in slices(batches, ROWS):
            counts, offsets, places, found = [], [0], [], []
            for text in batch.column("text").to_pylist():
                if len(hashes) > MAX_KNOWN:
                    hashes.clear()
                value = np.array(
                    list(map(hashes.__getitem__, words(text))), dtype=np.int64
                )
                keep = np.zeros(len(value), dtype=bool)
                bit = value & (FILTER_BITS - 1)
                at, shift = bit >> 3, (7 - (bit & 7)).astype(np.uint8)
                for n, bits in packed.items():
                    keep |= _in_runs((bits[at] >> shift & 1).view(bool), n)
                at = np.flatnonzero(keep)
                counts.append(len(value))
                offsets.append(offsets[-1] + len(at))
                places.append(at)
                found.append(value[at])
            places = np.concatenate([*places, np.empty(0, np.int64)]).astype(np.int32)
            found = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64)
            flat = pa.StructArray.from_arrays(
                [pa.array(places), pa.array(found)], fields=list(struct)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                ],
                names=["row", "doc_id", "mark", "n_words", "postings"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_mark(F.col("doc_id"), F.col("text")).alias("mark"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    schema = (
        "row long, doc_id long, mark long, n_words long, postings array<struct<pos:int,word:long>>"
    )
    return checkpoint_stage(rows.mapInArrow(run, schema))


def postings(index: DataFrame) -> DataFrame:
    return index.select("row", F.explode("postings").alias("p")).select("row", "p.pos", "p.word")


def _ordered(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows whose words all occur, with ``turn``: 1 for the rarest word, and so on."""
    times = postings(index).groupBy("word").agg(F.count("*").alias("times"))
    window = Window.partitionBy("item", "start")
    return checkpoint_stage(
        windows.join(times, "word")
        .withColumn("there", F.count("*").over(window))
        .filter("there = len")
        .withColumn("turn", F.row_number().over(window.orderBy("times", "off")))
        .select("item", "start", "len", "off", "word", "turn")
    )


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Exact matches: ``row``, ``begin`` (word position), ``len``, ``item``."""
    ordered = _ordered(index, windows)
    lists = postings(index)
    key, place = ["item", "start"], ["row", "pos", "word"]
    # The rarest word's list, shifted by its place in the window.
    found = (
        lists.join(ordered.filter("turn = 1"), "word")
        .select("row", (F.col("pos") - F.col("off")).alias("begin"), "len", *key)
        .filter("begin >= 0")
    )
    # The second rarest, where there is one; the candidates that are left go to all others.
    second = ordered.filter("turn = 2").select(*key, "off", "word")
    found = checkpoint_stage(
        found.filter("len > 1")
        .join(second, key)
        .withColumn("pos", F.col("begin") + F.col("off"))
        .join(lists, place, "left_semi")
        .select("row", "begin", "len", *key)
        .unionByName(found.filter("len = 1"))
    )
    others = ordered.filter("turn > 2").select(*key, "off", "word")
    whole = (
        found.filter("len > 2")
        .join(others, key)
        .withColumn("pos", F.col("begin") + F.col("off"))
        .join(lists, place, "left_semi")
        .groupBy("row", "begin", "len", *key)
        .agg(F.count("*").alias("n"))
        .filter("n = len - 2")
        .select("row", "begin", "len", "item")
    )
    return whole.unionByName(found.filter("len <= 2").select("row", "begin", "len", "item"))


def proximity_matches(index: DataFrame, windows: DataFrame, reach: int) -> DataFrame:
    """Windows whose words all occur within ``reach`` words of their rarest one, in any order.

    ``row``, ``pos`` of the rarest word, ``item``, ``start``. Needs an index built with
    ``runs_only=False``.
    """
    ordered = _ordered(index, windows)
    lists = postings(index)
    key = ["item", "start"]
    near = lists.join(ordered.filter("turn = 1").select(*key, "word"), "word").select(
        "row", F.col("pos").alias("centre"), *key
    )
    needed = ordered.select(*key, "word").distinct()
    many = needed.groupBy(*key).agg(F.count("*").alias("n_words"))
    return (
        near.join(needed, key)
        .join(lists, ["row", "word"])
        .filter(F.abs(F.col("pos") - F.col("centre")) <= reach)
        .groupBy("row", "centre", *key)
        .agg(F.countDistinct("word").alias("n"))
        .join(many, key)
        .filter("n = n_words")
        .select("row", F.col("centre").alias("pos"), *key)
    )


def _covered(spans: Column) -> Column:
    """Number of places under spans (begin, end), each place once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda state, s: F.struct(
            (state["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], state["end"])))
            .cast("long")
            .alias("n"),
            F.greatest(s["end"], state["end"]).alias("end"),
        ),
        lambda state: state["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document row: ``doc_id``, ``mark``, ``n_words``, ``n_hit``, ``items`` (ids, sorted),
    ``n_items``, ``contaminated``."""
    windows = checkpoint_stage(window_words(benchmark, size))
    index = build_index(docs, windows)
    found = checkpoint_stage(phrase_matches(index, windows))
    hits = (
        found.groupBy("row")
        .agg(
            F.collect_set(
                F.struct("begin", (F.col("begin") + F.col("len")).alias("end"))
            ).alias("spans")
        )
        .select("row", _covered(F.col("spans")).alias("n_hit"))
    )
    names = windows.select("item", "item_id").distinct()
    items = (
        found.select("row", "item")
        .distinct()
        .join(names, "item")
        .groupBy("row")
        .agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    return (
        index.select("row", "doc_id", "mark", "n_words")
        .join(hits.join(items, "row"), "row", "left")
        .select(
            "doc_id",
            "mark",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The query's rows, with the items' ids as a digest."""
    return contamination(docs, benchmark, size).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The documents without those that hold a benchmark window; all columns stay."""
    bad = checkpoint_stage(
        contamination(docs, benchmark, size).filter("contaminated").select("doc_id", "mark").distinct()
    ).toDF("b0", "b1")
    # Columns by position, so that no name of the input can clash.
    at = {name: F.col(f"c{i}") for i, name in enumerate(docs.columns)}
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    mark = text_mark(at["doc_id"], at["text"])
    same = at["doc_id"].cast("long").eqNullSafe(F.col("b0")) & (mark == F.col("b1"))
    return plain.join(bad, same, "left_anti").toDF(*docs.columns)
