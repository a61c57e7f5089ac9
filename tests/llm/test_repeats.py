import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rxlens.llm import repeats
from tests.conftest import rows

SCHEMA = "doc_id long, text string, spans string, n_chars long"


def brute(docs):
    """Every window counted."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    times = Counter(b[s : s + 200] for _, b in texts for s in range(len(b) - 199))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - 199):
            if times[b[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def hard_rows():
    rnd = random.Random(5)
    base = "".join(rnd.choice("abcé ") for _ in range(900))
    return [
        (1, None),
        (2, ""),
        (3, "x"),
        (4, base),
        (4, base),
        (5, base[100:350] + "Q" + base[350:700]),
        (None, base[:500]),
        (6, "ab" * 3000),
        (7, "For " * 300 + base[10:260]),
        (8, "é" * 300),
        (9, base[:199]),
        (9, base[:200]),
        (10, "z" * 201),
        (11, "y" * 199),
        (12, "".join(rnd.choice("xyzw") for _ in range(5000))),
    ]


# With a limit of one context, every anchor with differing texts takes the hot path.
@pytest.mark.parametrize("max_contexts", [2000, 1])
def test_every_window_is_judged(spark, max_contexts):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in hard_rows()], SCHEMA)
    assert rows(repeats.repeat_report(docs, max_contexts)) == brute(hard_rows())


def test_whole_table_against_all_windows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = rows(repeats.repeat_report(docs))
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(r[2] for r in got) > 0


def test_empty_table(spark):
    assert repeats.repeat_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_texts_without_repeats_keep_rows_and_columns(spark):
    docs = spark.createDataFrame([(i, t, "s", 7) for i, t in hard_rows()], SCHEMA)
    out = repeats.drop_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    left = {(r["doc_id"], r["n_chars"]) for r in out.collect()}
    assert (12, 5000) in left and (4, 0) in left and (1, 7) in left


def test_buckets_and_shards_change_nothing(spark):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in hard_rows()], SCHEMA)

    def spans(**sizes):
        found = repeats.repeated_spans(docs, **sizes).collect()
        joined = [(r["doc_id"], r["dh"], repeats.joined_spans(r["spans"])) for r in found]
        return sorted(joined, key=repr)

    assert spans(bucket_bytes=1, shards=1) == spans(bucket_bytes=1 << 30, shards=7)


def test_anchors_own_each_window_once():
    rnd = np.random.default_rng(0)
    data = rnd.integers(97, 100, 150_000).astype(np.uint8)
    ends = np.array([100, 70_000, 70_000, 149_990, 150_000])
    starts = np.concatenate(([0], ends[:-1]))
    first, n, behind, _ = repeats.owned_windows(data, starts, ends)
    owned = np.concatenate([np.arange(a, a + k) for a, k in zip(first, n)])
    want = np.concatenate([np.arange(a, max(a, b - 199)) for a, b in zip(starts, ends)])
    assert sorted(owned.tolist()) == want.tolist()
    assert (behind <= repeats.WINDOW - repeats.ANCHOR).all()
