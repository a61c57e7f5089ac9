"""Removal of byte strings that occur more than once in a corpus, exactly.

A string of ``WINDOW`` bytes that starts at two places (of one document or of two) is
*repeated*, and every byte under a repeated string goes. Strings are judged on the input.

1. **Anchors.** Each window of ``WINDOW`` bytes picks the leftmost smallest hash among its
   ``ANCHOR``-byte substrings. Equal windows pick equal anchors at equal offsets, so windows
   need comparing only where their anchors are equal. An anchor owns a run of windows; one
   row per anchor (about one in 85 bytes) leaves the documents, not one per byte.
2. **Groups.** Rows are counted by anchor. An anchor that occurs once owns no repeated
   window. If all its occurrences own the same text, all their windows are repeated.
3. **Transforms.** Where the owned texts of an anchor differ, its distinct texts must be
   compared. Anchors are dealt into buckets of about ``BUCKET_BYTES``, the texts of a bucket
   into ``SHARDS`` shards by their hash, and each shard becomes one row that holds its
   Burrows-Wheeler transform (``transforms.transform``). The texts go no further.
4. **Merge.** The transforms of a bucket are merged by interleave refinement
   (``transforms.common_lengths``), which gives each window the length it shares with another
   one; those that share ``WINDOW`` bytes are the repeated strings.
5. **Hot anchors.** An anchor with more than ``MAX_CONTEXTS`` different texts does not meet in
   one task: its windows are counted by a 128-bit hash in a plain aggregation instead, which
   Spark combines before the shuffle. Nothing is left out, but that part is no merge.

Two hashes are trusted: texts around one anchor are told apart by 64 bits, and the windows of hot
anchors by 128. Anchors that collide only share a bucket; their bytes decide.

Defined results: a null text is empty; a text shorter than a window loses nothing; rows that
repeat (same id, same text) are documents of their own, so a long one loses everything; a null
``doc_id`` is kept. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import slices
from rxlens.llm.transforms import Transform, common_lengths, transform
from rxlens.operators.reuse import checkpoint_stage

WINDOW = 200
ANCHOR = 32
MAX_CONTEXTS = 2000
BUCKET_BYTES = 1 << 17
SHARDS = 4
#: Rows of a batch that are held as lists at a time: texts, and contexts with all their windows.
ROWS, WINDOW_ROWS = 512, 128
_STEP = 1 << 16
_LOW = np.uint64(0x1FFFF)

_rng = np.random.default_rng(20240229)
_BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_LEVELS = [
    (np.uint64(a | 1), np.uint64(b | 1))
    for a, b in _rng.integers(1, 2**63, (8, 2), dtype=np.uint64).tolist()
]
del _rng


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each position, by doubling the hashed length."""
    h, width, level = _BYTE_HASH[data], 1, 0
    while width < ANCHOR:
        a, b = _LEVELS[level]
        h = h[:-width] * a + h[width:] * b
        h ^= h >> np.uint64(29)
        width, level = 2 * width, level + 1
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def owned_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The anchors of documents that lie end to end in ``data``.

    Returns arrays: first owned window start, number of owned windows, position of the anchor
    behind the first start, and the anchor's hash. Windows never cross a document.
    """
    grams = WINDOW - ANCHOR + 1
    valid = np.zeros(len(data) + 1, dtype=np.int32)
    fits = ends - starts >= WINDOW
    np.add.at(valid, starts[fits], 1)
    np.add.at(valid, ends[fits] - WINDOW + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    edge = np.zeros(len(data), dtype=bool)
    edge[starts[fits]] = True
    found = []
    for at in range(0, max(0, len(data) - WINDOW + 1), _STEP):
        piece = data[at : at + _STEP + WINDOW - 1]
        if len(piece) < WINDOW:
            break
        h = _gram_hashes(piece)
        low = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), grams)
        anchor = (low & _LOW).astype(np.int64)
        n = len(anchor)
        ok = valid[at : at + n]
        new = np.empty(n, dtype=bool)
        new[0] = True
        new[1:] = (anchor[1:] != anchor[:-1]) | ~ok[:-1] | edge[at + 1 : at + n]
        first = np.flatnonzero(new & ok)
        if not len(first):
            continue
        stop = np.flatnonzero(np.append(new | ~ok, True))
        length = stop[np.searchsorted(stop, first, side="right")] - first
        a = anchor[first]
        found.append((first + at, length, a - first, h[a].view(np.int64)))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


_ANCHORS = "doc_id long, dh long, anchor long, owned long, at int, n int"


def _texts(column) -> tuple[memoryview, np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary column, and where each value starts and ends."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    base = int(offsets[0])
    return view[base : int(offsets[-1])], offsets[:-1] - base, offsets[1:] - base


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, 1000):
            batch = whole.slice(low, 1000)
            view, starts, ends = _texts(batch.column("text"))
            first, n, behind, anchor = owned_windows(
                np.frombuffer(view, dtype=np.uint8), starts, ends
            )
            spans = zip(first.tolist(), (first + n + WINDOW - 1).tolist(), behind.tolist())
            digest = xxhash.xxh3_64_intdigest
            owned = np.fromiter(
                (digest(view[a:b], s) for a, b, s in spans), dtype=np.uint64, count=len(first)
            )
            doc = np.searchsorted(starts, first, side="right") - 1
            # Empty documents share a start with the next; the last of them owns the bytes.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    batch.column("dh").take(pa.array(doc)),
                    pa.array(anchor),
                    pa.array(owned.view(np.int64)),
                    pa.array((first - starts[doc]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                ],
                names=["doc_id", "dh", "anchor", "owned", "at", "n"],
            )


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``dh``: id and hash together name a text, even if ids repeat."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("dh")
    )


def anchors(docs: DataFrame) -> DataFrame:
    """One row per anchor of every whole text: where its owned windows start, and how many."""
    return keyed(docs).mapInArrow(_anchor_rows, _ANCHORS)


def _runs(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_RUNS = "array<struct<lo:int,hi:int>>"
_VERDICTS = f"anchor long, owned long, runs {_RUNS}"
_RUNS_ARROW = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


_SHARDS = (
    "bucket long, shard int, symbols binary, whole int, ends array<int>, counts array<int>, "
    "anchors array<long>, owned array<long>, copies array<long>"
)
_SHARDS_ARROW = pa.schema(
    [("bucket", pa.int64()), ("shard", pa.int32()), ("symbols", pa.binary())]
    + [("whole", pa.int32()), ("ends", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
    + [(c, pa.list_(pa.int64())) for c in ("anchors", "owned", "copies")]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _transforms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``bucket, shard, anchor, owned, copies, body`` come sorted; one row per shard goes."""
    for (bucket, shard), rows in groupby(_rows(batches), key=itemgetter(0, 1)):
        _, _, anchors, owned, copies, bodies = zip(*rows)
        made = transform(list(bodies))
        counts = [max(0, len(body) - WINDOW + 1) for body in bodies]
        row = (bucket, shard, made.symbols.tobytes(), made.whole, made.ends.tolist(), counts)
        row += (list(anchors), list(owned), list(copies))
        yield pa.RecordBatch.from_pylist([dict(zip(_SHARDS_ARROW.names, row))], _SHARDS_ARROW)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards come sorted by bucket; each bucket's transforms are merged into verdicts."""
    for _, rows in groupby(_rows(batches), key=itemgetter(0)):
        shards = list(rows)
        counts = [np.array(x[5], dtype=np.int32) for x in shards]
        lengths = common_lengths(
            [
                Transform(np.frombuffer(x[2], dtype=np.uint8), x[3], np.array(x[4], np.int32))
                for x in shards
            ],
            counts,
            WINDOW,
        )
        found = []
        for (*_, anchors, owned, copies), count, length in zip(shards, counts, lengths):
            hit = (length == WINDOW) | np.repeat(np.array(copies) > 1, count)
            hits = np.split(hit, np.cumsum(count)[:-1])
            found += [(a, o, r) for a, o, h in zip(anchors, owned, hits) if (r := _runs(h))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[1] for x in found], pa.int64()),
                pa.array([x[2] for x in found], _RUNS_ARROW),
            ],
            names=["anchor", "owned", "runs"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The owned texts of the contexts asked for, out of their documents."""
    names = ["anchor", "owned", "copies", "hot", "body"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    for batch in slices(batches, ROWS):
        out: list[tuple] = []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, wanted in zip(texts, batch.column("wanted").to_pylist()):
            for w in wanted:
                body = text[w["at"] : w["at"] + w["n"] + WINDOW - 1]
                out.append((w["anchor"], w["owned"], w["copies"], w["hot"], body))
        columns = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names
        )


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "owned", "copies", "off", "h1", "h2"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    for batch in slices(batches, WINDOW_ROWS):
        columns = [batch.column(c).to_pylist() for c in ("anchor", "owned", "copies", "body")]
        out = []
        for anchor, owned, copies, body in zip(*columns):
            for off in range(len(body) - WINDOW + 1):
                h = xxhash.xxh3_128_digest(body[off : off + WINDOW])
                h1 = int.from_bytes(h[:8], "big", signed=True)
                h2 = int.from_bytes(h[8:], "big", signed=True)
                out.append((anchor, owned, copies, off, h1, h2))
        found = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(found, types)], names=names
        )


def _merged(contexts: DataFrame, bucket_bytes: int, shards: int) -> DataFrame:
    """Verdicts by merging transforms: a row per shard, then a merge per bucket of anchors."""
    size = F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("size")
    buckets = contexts.agg(size).first()["size"] // bucket_bytes + 1
    keys = [
        F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"),
        F.pmod("owned", F.lit(shards)).cast("int").alias("shard"),
    ]
    return (
        contexts.select(*keys, "anchor", "owned", "copies", "body")
        .repartition("bucket", "shard")
        .sortWithinPartitions("bucket", "shard", "anchor", "owned")
        .mapInArrow(_transforms, _SHARDS)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "shard")
        .mapInArrow(_merge, _VERDICTS)
    )


def _counted(contexts: DataFrame) -> DataFrame:
    """Verdicts for hot anchors: windows counted by hash, combined before the shuffle."""
    windows = contexts.mapInArrow(
        _window_hashes, "anchor long, owned long, copies long, off int, h1 long, h2 long"
    )
    twice = (
        windows.groupBy("h1", "h2").agg(F.sum("copies").alias("times")).filter("times > 1")
    ).select("h1", "h2")
    return (
        windows.join(twice, ["h1", "h2"])
        .groupBy("anchor", "owned")
        .agg(
            F.collect_list(
                F.struct(F.col("off").alias("lo"), (F.col("off") + 1).alias("hi"))
            ).alias("runs")
        )
    )


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["dh"] == b["dh"])


def repeated_spans(
    docs: DataFrame,
    max_contexts: int = MAX_CONTEXTS,
    bucket_bytes: int = BUCKET_BYTES,
    shards: int = SHARDS,
) -> DataFrame:
    """Byte spans under repeated strings, as one array ``spans`` per text that has any.

    Spans may overlap. Keyed by ``doc_id`` and ``dh`` as in ``keyed``.
    """
    found = checkpoint_stage(anchors(docs))
    groups = (
        found.groupBy("anchor")
        .agg(F.count("*").alias("times"), F.min("owned").alias("a"), F.max("owned").alias("b"))
        .filter("times > 1")
        .select("anchor", (F.col("a") != F.col("b")).alias("mixed"))
    )
    # Written first, so that adaptive execution can split a hot anchor in the join.
    repeated = checkpoint_stage(found.join(checkpoint_stage(groups), "anchor"))
    mixed = repeated.filter("mixed").drop("mixed")

    one = F.struct("doc_id", "dh", "at")
    distinct = mixed.groupBy("anchor", "owned", "n").agg(
        F.count("*").alias("copies"), F.min(one).alias("one")
    )
    distinct = checkpoint_stage(distinct)
    sizes = distinct.groupBy("anchor").agg((F.count("*") > max_contexts).alias("hot"))
    wanted = (
        distinct.join(sizes, "anchor")
        .select(
            "one.doc_id",
            "one.dh",
            F.struct("anchor", "owned", "copies", "hot", "one.at", "n").alias("w"),
        )
        .groupBy("doc_id", "dh")
        .agg(F.collect_set("w").alias("wanted"))
    )
    texts = keyed(docs)
    # Copies of a row cut the same contexts; a set of them is one context with its count.
    contexts = checkpoint_stage(
        texts.join(wanted, same_document(texts, wanted))
        .select(texts["text"], "wanted")
        .mapInArrow(_cut, "anchor long, owned long, copies long, hot boolean, body binary")
        .groupBy("anchor", "owned")
        .agg(
            F.max("copies").alias("copies"),
            F.max("hot").alias("hot"),
            F.max("body").alias("body"),
        )
    )
    plain = _merged(contexts.filter("not hot"), bucket_bytes, shards)
    verdicts = plain.unionByName(_counted(contexts.filter("hot")))
    partly = (
        mixed.join(verdicts, ["anchor", "owned"])
        .select("doc_id", "dh", "at", F.explode("runs").alias("r"))
        .select(
            "doc_id",
            "dh",
            (F.col("at") + F.col("r.lo")).alias("lo"),
            (F.col("at") + F.col("r.hi") + (WINDOW - 1)).alias("hi"),
        )
    )
    wholly = repeated.filter("not mixed").select(
        "doc_id",
        "dh",
        F.col("at").alias("lo"),
        (F.col("at") + F.col("n") + (WINDOW - 1)).alias("hi"),
    )
    return (
        wholly.unionByName(partly)
        .groupBy("doc_id", "dh")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    )


def joined_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the spans."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def kept_pieces(text: bytes, runs: list[tuple[int, int]]) -> Iterator[bytes]:
    at = 0
    for lo, hi in runs:
        yield text[at:lo]
        at = hi
    yield text[at:]


_REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, ROWS):
        rows = []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, spans in zip(texts, batch.column("spans").to_pylist()):
            runs = joined_spans(spans)
            digest = hashlib.sha256()
            for piece in kept_pieces(text, runs):
                digest.update(piece)
            rows.append((len(text), sum(b - a for a, b in runs), len(runs), digest.hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")]
            + [pa.array(c, pa.int64()) for c in columns[:3]]
            + [pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def with_spans(docs: DataFrame, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """``doc_id``, ``dh``, ``text`` and ``spans`` (null where nothing repeats)."""
    spans = repeated_spans(docs, max_contexts)
    texts = keyed(docs)
    return texts.join(spans, same_document(texts, spans), "left").select(
        texts["doc_id"], texts["dh"], texts["text"], "spans"
    )


def repeat_report(docs: DataFrame, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs, SHA-256 of what is left."""
    return with_spans(docs, max_contexts).mapInArrow(_report, _REPORT)


def kept_text(text: bytes, spans: list[dict] | None) -> str:
    """What is left, as text. Bytes of a character that a cut split are dropped."""
    runs = joined_spans(spans)
    return b"".join(kept_pieces(text, runs)).decode("utf-8", "ignore")


def drop_repeats(docs: DataFrame, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """The documents with repeated strings cut out of ``text``; ``n_chars`` follows if there.

    Every row and every other column stays.
    """
    spans = repeated_spans(docs, max_contexts)
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    types = dict(docs.dtypes)
    text_at = f"c{names.index('text')}"
    # The text travels once; a flag tells which texts were null.
    rows = docs.select(
        *[F.col(f"`{c}`").alias(i) for c, i in zip(names, inner) if i != text_at],
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("text").isNull().alias("none"),
    ).withColumn("dh", F.xxhash64("doc_id", "text"))
    others = [i for i in inner if i != text_at]
    joined = rows.join(spans, same_document(rows, spans), "left").select(
        *others, rows["text"].alias("text"), "none", "spans"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            kept = [
                None if none else kept_text(text, spans)
                for text, spans, none in zip(
                    texts, batch.column("spans").to_pylist(), batch.column("none").to_pylist()
                )
            ]
            arrays = [batch.column(i) for i in others] + [pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*others, text_at])

    schema = joined.select(*others).schema.add(text_at, "string")
    out = joined.mapInArrow(cut, schema)
    out = out.select(*[F.col(i).alias(c) for c, i in zip(names, inner)])
    if "n_chars" in types:
        size = F.length("text").cast(types["n_chars"])
        out = out.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))
    return out.select(*names)
