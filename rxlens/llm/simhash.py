"""Near-duplicate texts by SimHash fingerprints, found with multi-index hashing.

Fingerprints link at ``MAX_BITS`` or fewer differing bits. A fingerprint is cut into two
segments of 32 bits; if two differ in three bits, one segment differs in one bit at most.
So each fingerprint enumerates, per segment, the Hamming ball of radius one (33 values),
fetches the fingerprints that have such a value in a table keyed by segment, and verifies
the whole distance. Copies collapse into one fingerprint before anything is enumerated.

A table entry with more than ``MAX_ENTRY`` fingerprints is not paired out. There the search
goes on in the other segment: members are sent to the values around their other half (radius
one and two), and at each such value all link to one member that is known to be in reach.
That makes as many rows as members times a constant and loses no connection (``_starred``).

Links run between fingerprints, never between rows; components come from alternating star
contractions, one written table per round.

Defined results: a null or empty text has no words and fingerprint zero, linked like any
other; a text of fewer words than a shingle is one shingle; rows that repeat are rows of one
fingerprint; ``component_id`` is the smallest non-null id reachable, null only if all are null.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import slices, text_mark
from rxlens.operators.reuse import checkpoint_stage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
MAX_ENTRY = 64
_HALF = 0xFFFFFFFF
_SUM_ROWS = 1 << 14
#: Rows of a batch that are held as lists at a time.
ROWS = 512


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of word shingles; ASCII letters in lower case, ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SUM_ROWS):
        part = hashes[at : at + _SUM_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``mark`` (see ``text_mark``) and ``fp`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            texts = batch.column("text").to_pylist()
            found = [fingerprint(x, shingle) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(found, pa.int64())],
                names=["doc_id", "mark", "fp"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_mark(F.col("doc_id"), F.col("text")).alias("mark"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ).mapInArrow(run, "doc_id long, mark long, fp long")


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(_HALF))


def _flips(radius: int) -> Column:
    """Masks of exactly ``radius`` of 32 bits, for radius 0 to 2."""
    if radius == 0:
        return F.array(F.lit(0).cast("long"))
    one = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    if radius == 1:
        return one
    return F.flatten(
        F.transform(
            one, lambda a: F.transform(F.filter(one, lambda b: b < a), lambda b: a.bitwiseOR(b))
        )
    )


def _ball(value: Column, *radii: int) -> Column:
    """The values at the given distances from ``value``."""
    masks = F.concat(*[_flips(r) for r in radii])
    return F.explode(F.transform(masks, lambda m: value.bitwiseXOR(m)))


def _entries(distinct: DataFrame) -> DataFrame:
    """The tables of both segments: segment, its value, the other half, the fingerprint."""
    fp = F.col("fp")
    halves = F.array(
        F.struct(F.lit(0).alias("seg"), _high(fp).alias("value"), _low(fp).alias("rest")),
        F.struct(F.lit(1).alias("seg"), _low(fp).alias("value"), _high(fp).alias("rest")),
    )
    return distinct.select("fp", F.explode(halves).alias("h")).select("fp", "h.*")


def _paired(table: DataFrame, probes: DataFrame) -> DataFrame:
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= MAX_BITS
    return (
        table.join(probes, ["seg", "value"])
        .filter((F.col("probe") != F.col("fp")) & near)
        .select(F.greatest("fp", "probe").alias("u"), F.least("fp", "probe").alias("v"))
    )


def _starred(residents: DataFrame, visitors: DataFrame) -> DataFrame:
    """Links inside crowded entries, without pairing their members.

    A resident has the entry's value, a visitor differs from it in one bit. At a value ``b``
    of the other half, residents at distance 0 or 1 are *cores*. Cores link to each other
    (distance 2 at most), to residents at distance 2 of ``b`` (3 at most) and to visitors at
    distance 0 or 1 (1 + 2 at most). Two members in reach of each other always meet a core at
    some ``b`` between them, so linking all to one core keeps every connection.
    """
    cores = residents.select("seg", "value", "fp", _ball(F.col("rest"), 0, 1).alias("b"))
    outer = residents.select("seg", "value", "fp", _ball(F.col("rest"), 2).alias("b"))
    guests = visitors.select(
        "seg", "value", F.col("probe").alias("fp"), _ball(F.col("rest"), 0, 1).alias("b")
    )
    place = ["seg", "value", "b"]
    centre = cores.groupBy(*place).agg(F.min("fp").alias("centre"))
    return (
        reduce(DataFrame.unionByName, [cores, outer, guests])
        .join(centre, place)
        .filter("fp != centre")
        .select(F.greatest("fp", "centre").alias("u"), F.least("fp", "centre").alias("v"))
    )


def links(distinct: DataFrame, max_entry: int = MAX_ENTRY) -> DataFrame:
    """Links ``u > v`` between fingerprints that connect all pairs within ``MAX_BITS``."""
    table = _entries(distinct)
    place = ["seg", "value"]
    crowded = checkpoint_stage(
        table.groupBy(*place).count().filter(F.col("count") > max_entry).drop("count")
    )
    probes = table.select("seg", _ball(F.col("value"), 0, 1).alias("value"), F.col("fp").alias("probe"))
    found = _paired(table.join(crowded, place, "left_anti"), probes)
    if crowded.isEmpty():
        return found.distinct()
    visitors = table.select(
        "seg", _ball(F.col("value"), 1).alias("value"), F.col("fp").alias("probe"), "rest"
    ).join(crowded, place, "left_semi")
    residents = table.join(crowded, place, "left_semi")
    return found.unionByName(_starred(residents, visitors)).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        edges.join(least, "u")
        .filter("v > m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for all nodes with links."""
    edges = checkpoint_stage(edges)
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = tuple(edges.agg(*mark).first())
    while before[0]:
        edges = checkpoint_stage(_small_star(_large_star(edges)))
        after = tuple(edges.agg(*mark).first())
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_entry: int = MAX_ENTRY
) -> DataFrame:
    """``doc_id``, ``mark``, ``fp``, ``root`` and ``component_id`` for every row.

    ``root`` names the component by its smallest fingerprint and is never null.
    """
    rows = checkpoint_stage(fingerprints(docs, shingle))
    distinct = checkpoint_stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), max_entry))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(placed.join(ids, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "mark", "fp", "root", "component_id"
    )


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """The query's rows: fingerprint as 16 hexadecimal digits, and the component."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_duplicates(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component: the smallest id's; of rows with equal ids, any one.

    All columns stay. A component whose ids are all null keeps one row.
    """
    near = near_duplicates(docs, shingle)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = near.groupBy("root").agg(F.min(order).alias("f")).select("f.doc_id", "f.mark")
    times = near.groupBy("doc_id", "mark").agg(F.count("*").alias("times"))
    kept = checkpoint_stage(
        first.join(
            times.select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), "times"),
            F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")),
        ).select("i", "m", "times")
    ).toDF("k0", "k1", "k2")
    # Columns by position, so that no name of the input can clash.
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {name: F.col(c) for c, name in zip(names, docs.columns)}
    hits = docs.toDF(*names).join(
        kept,
        at["doc_id"].cast("long").eqNullSafe(F.col("k0"))
        & (text_mark(at["doc_id"], at["text"]) == F.col("k1")),
    )
    once = hits.filter("k2 = 1")
    again = hits.filter("k2 > 1").dropDuplicates(["k0", "k1"])
    return once.unionByName(again).select(*names).toDF(*docs.columns)
