import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
import tiktoken

from rxlens.llm import bpe
from rxlens.llm.queries import LLM_QUERIES, RANKS
from tests.conftest import rows

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_pieces_as_the_library(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 3000)  # the table is emptied on the way
    transducer = bpe.Transducer(ranks)
    rnd = random.Random(1)
    entries = list(ranks)
    for _ in range(4000):
        kind = rnd.randrange(4)
        if kind == 0:
            piece = bytes(rnd.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(20))
        elif kind == 1:
            piece = bytes(rnd.randrange(256) for _ in range(rnd.randint(1, 12)))
        elif kind == 2:
            piece = b"".join(rnd.choice(entries) for _ in range(rnd.randint(1, 5)))
        else:
            piece = bytes(rnd.choice(b"ae") for _ in range(rnd.randint(1, 60)))
        assert transducer.encode_piece(piece) == library._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("together, short", [(16_384, 64), (700, 9), (1, 64)])
def test_pieces_that_step_together(ranks, library, monkeypatch, together, short):
    monkeypatch.setattr(bpe, "MAX_STATES", 500)  # the table is emptied on the way
    monkeypatch.setattr(bpe, "TOGETHER", together)
    monkeypatch.setattr(bpe, "SHORT", short)
    rnd = random.Random(2)
    pieces = [bytes(rnd.choice(b"aeinrt ") for _ in range(rnd.randint(1, 14))) for _ in range(5000)]
    pieces += [b" the" * 40, pieces[0], b"\xff", "é".encode() * 3000]
    ids, counts = bpe.Transducer(ranks).encode_many(pieces)
    want = [library._core_bpe.encode_single_piece(p) for p in pieces]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    ids, counts = bpe.Transducer(ranks).encode_many([])
    assert len(ids) == len(counts) == 0


def test_entries_that_merging_cannot_reach():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"bc": 4, b"abca": 5}
    transducer = bpe.Transducer(ranks)
    assert transducer.encode_piece(b"abca") == [5]
    assert transducer.encode_piece(b"abcab") == [3, 2, 3]


def test_long_pieces_need_bounded_lookahead(ranks, library, monkeypatch):
    rnd = random.Random(3)
    mixed = bytes(rnd.choice(b"aeinrst ") for _ in range(9000))
    for step in (4096, 33):
        monkeypatch.setattr(bpe, "LONG", step)
        transducer = bpe.Transducer(ranks)
        for piece in (b"a" * 30_000, b" " * 5000, "é".encode() * 4000, mixed):
            assert transducer.encode_piece(piece) == library._core_bpe.encode_single_piece(piece)


def test_whole_table_as_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = []
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        want.append((r["doc_id"], len(ids), listed, back))
    assert rows(LLM_QUERIES["op8_byte_bpe"](spark, sf_dir)) == sorted(want, key=repr)


def test_hard_rows_come_back(spark):
    texts = [(1, None), (None, ""), (2, "a<|endoftext|> é" * 500), (2, "x"), (3, "🙂" * 9)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, ids int")
    encoded = bpe.encode(docs, RANKS, PATTERN)
    assert rows(bpe.decode(encoded, RANKS)) == sorted([(i, t or "") for i, t in texts], key=repr)
    assert bpe.encode_checked(docs, RANKS, PATTERN).count() == 5
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).collect() == []


def test_state_machine_as_strict_decoder():
    rnd = random.Random(1)
    for _ in range(5000):
        data = bytes(
            rnd.choice([65, 0xC3, 0xA9, 0xE0, 0xA0, 0x80, 0xF0, 0x9F, 0xED, 0xBF, rnd.randrange(256)])
            for _ in range(rnd.randint(0, 12))
        )
        machine, out, at = bpe.Utf8Decoder(), "", 0
        while at < len(data):
            step = rnd.randint(1, 4)
            out += machine.push(data[at : at + step])
            at += step
        assert out + machine.end() == data.decode("utf-8", "replace")


@pytest.mark.parametrize("listed, max_pieces", [(1 << 20, 400_000), (30, 400_000), (200, 5), (1, 2)])
def test_texts_that_learn_together_keep_their_own_ids(ranks, monkeypatch, listed, max_pieces):
    monkeypatch.setattr(bpe, "LISTED", listed)
    texts = ["", "hello hello", "x", "", "naïve café 12345", "hello x", "zq" * 60, "", "hello hello"]
    codec = bpe.Codec(ranks, PATTERN, max_pieces)
    alone = bpe.Codec(ranks, PATTERN)
    got = [
        [i for found in entries for entry in found for i in entry[0]]
        for entries in codec.entries_of(texts)
    ]
    assert got == [alone.encode(text) for text in texts]
    assert list(codec.entries_of([])) == []


def test_what_a_codec_keeps_of_a_piece_is_small(ranks):
    rnd = random.Random(4)
    words = ["".join(rnd.choices("aeinrstlod", k=rnd.randint(4, 9))) for _ in range(30_000)]
    codec = bpe.Codec(ranks, PATTERN)
    tracemalloc.start()
    try:
        assert len(codec.encode(" ".join(words))) > len(words)
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(codec.known) > 25_000
    assert kept / len(codec.known) < 800


@pytest.mark.parametrize("part", [1, 3, 1 << 14])
def test_bytes_and_digits_of_ids(ranks, library, monkeypatch, part):
    monkeypatch.setattr(bpe, "PART", part)
    text = "a naïve 🙂 café, 12345 zqzqzq\n" * 20
    codec = bpe.Codec(ranks, PATTERN)
    ids = [entry.ids for found in codec.entries(text) for entry in found]
    want = library.encode_ordinary(text)
    assert [i for run in ids for i in run.tolist()] == want
    assert b"".join(b for run in ids for b in codec.decode_bytes(run)) == text.encode()
    digits = b"".join(d for run in ids for d in codec.decimals(run))
    assert digits == "".join(f"{i}," for i in want).encode()


def test_checked_ids_are_those_of_the_library(spark, library):
    texts = [(1, "naïve 🙂 café " * 300), (2, ""), (3, None), (4, "zq" * 3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.encode_checked(docs, RANKS, PATTERN).collect()}
    for i, text in texts:
        want = library.encode_ordinary(text or "")
        assert (got[i]["n_tokens"], got[i]["ids"]) == (len(want), want)
