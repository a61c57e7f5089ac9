"""How much a task holds: few rows of a large batch as objects, and a bounded codec."""

import random
import sys
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest

from rxlens.llm import bpe, repeats, toxicity
from rxlens.llm.queries import RANKS

N = 4000


def wanted_texts():
    asked = [{"anchor": i, "owned": i, "copies": 1, "hot": False, "at": 5, "n": 1} for i in range(4)]
    texts = [f"{i:08d}" * 600 for i in range(N)]
    kind = [(k, pa.bool_() if k == "hot" else pa.int64()) for k in asked[0]]
    columns = [pa.array(texts), pa.array([asked] * N, pa.list_(pa.struct(kind)))]
    return pa.RecordBatch.from_arrays(columns, names=["text", "wanted"])


def contexts():
    ids = pa.array(range(N), pa.int64())
    bodies = pa.array([(b"%08d" % i) * 33 for i in range(N)])
    return pa.RecordBatch.from_arrays([ids, ids, ids, bodies], names=["anchor", "owned", "copies", "body"])


def labelled_texts():
    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(N)]
    columns = [pa.array(range(N), pa.int64()), pa.array([True] * N), pa.array(texts)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "text"])


@pytest.mark.parametrize(
    "run, batch, out, most",
    [
        (repeats._cut, wanted_texts, 4 * N, 9e6),
        (repeats._window_hashes, contexts, 65 * N, 9e6),
        (toxicity._sentences, labelled_texts, 2 * N, 18e6),
    ],
)
def test_few_rows_of_a_batch_are_objects(run, batch, out, most):
    whole = batch()
    tracemalloc.start()
    try:
        assert sum(found.num_rows for found in run(iter([whole]))) == out
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < most


def test_pieces_that_a_codec_keeps_are_bounded():
    rnd = random.Random(5)
    words = list({"".join(rnd.choices("aeinrstlod", k=7)) for _ in range(200_000)})
    codec = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    text = " ".join(words)
    ids = [i for found in codec.entries(text) for entry in found for i in entry.ids.tolist()]
    assert "".join(codec.decode(ids)) == text
    known = codec.known
    held = sys.getsizeof(known) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in known.items())
    assert held < 20e6
