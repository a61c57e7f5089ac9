import random

import numpy as np
import public_tokenizers
import tiktoken

from rxlens.llm import bpe, tokens
from rxlens.llm.queries import LLM_QUERIES, RANKS

PATTERN = public_tokenizers.PATTERN


def brute(ends, bounds):
    out, start = [], 0
    for end in ends:
        inside = [min(end, b) - max(start, a) for a, b in bounds]
        most = max(inside, default=0)
        out.append(inside.index(most) if most > 0 else -1)
        start = end
    return out


def test_rule_against_every_overlap():
    rnd = random.Random(4)
    for _ in range(2000):
        ends = np.cumsum([rnd.randint(1, 5) for _ in range(rnd.randint(0, 8))]).astype(np.int64)
        size = int(ends[-1]) if len(ends) else 0
        cuts = sorted(rnd.sample(range(size + 1), min(size + 1, 2 * rnd.randint(0, 3)) // 2 * 2))
        bounds = np.array(cuts, dtype=np.int64).reshape(-1, 2)
        assert tokens.allocate(ends, bounds).tolist() == brute(ends.tolist(), bounds.tolist())


def test_whole_table_by_library_offsets(spark, sf_dir):
    library = tiktoken.Encoding(
        "t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in LLM_QUERIES["op3_token_counts"](spark, sf_dir).collect():
        text, ends, bounds, at = texts[r["doc_id"]], [], [], 0
        for i in library.encode_ordinary(text):
            ends.append((ends[-1] if ends else 0) + len(library.decode_single_token_bytes(i)))
        for line in text.encode().split(b"\n"):
            if line.strip():
                bounds.append((at, at + len(line)))
            at += len(line) + 1
        want = brute(ends, bounds)
        assert r["n_tokens"] == len(ends) and r["n_sections"] == len(bounds)
        assert r["section_tokens"] == [want.count(i) for i in range(len(bounds))]
        assert r["between_tokens"] == want.count(-1)


def test_hard_rows(spark):
    odd = [(1, None, "en"), (2, "", "en"), (2, "\n \n", None), (None, "a b\n\nc", "y")]
    df = spark.createDataFrame([(*r, "z") for r in odd], "doc_id long, text string, lang string, n_tokens string")
    got = {(r["doc_id"], r["n_sections"]) for r in tokens.count_sections(df, RANKS, PATTERN).collect()}
    assert got == {(1, 0), (2, 0), (None, 2)}
    fields = tokens.count_fields(df, ["lang", "text"], RANKS, PATTERN).collect()
    assert all(sum(r["field_tokens"]) == r["n_tokens"] for r in fields)
    assert tokens.count_sections(df.limit(0), RANKS, PATTERN).collect() == []
