import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from rxlens.llm import simhash
from tests.conftest import rows


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
                parent[find(a)] = find(b)
    return {v: find(v) for v in ordered}


def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    roots = brute_components(set(prints.values()))
    least = {}
    for i, f in prints.items():
        least[roots[f]] = min(least.get(roots[f], i), i)
    want = sorted(((i, f"{f:016x}", least[roots[f]]) for i, f in prints.items()), key=repr)
    assert rows(simhash.near_duplicate_report(docs)) == want
    kept = {r["doc_id"] for r in simhash.keep_first(docs).collect()}
    assert kept == set(least.values())


# Small limits send crowded entries to the star search.
@pytest.mark.parametrize("max_entry", [64, 2, 0])
def test_dense_clusters_stay_connected(spark, max_entry):
    rnd = random.Random(3)
    prints = set()
    for base in [0] + [rnd.getrandbits(64) for _ in range(4)]:
        for _ in range(40):
            x = base
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x - 2**64 if x >= 2**63 else x)
    groups = {}
    for v, root in brute_components(prints).items():
        groups.setdefault(root, set()).add(v)
    want = sorted(sorted(g) for g in groups.values() if len(g) > 1)
    distinct = spark.createDataFrame([(v,) for v in sorted(prints)], "fp long")
    got = {}
    for r in simhash.components(simhash.links(distinct, max_entry)).collect():
        got.setdefault(r["root"], {r["root"]}).add(r["node"])
    assert sorted(sorted(g) for g in got.values()) == want


def test_hard_rows(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (None, None), (4, "Abc  d"), (5, "abc d")]
    texts += [(5, "abc d"), (6, "a b c d e f g" * 2000), (None, "zzz y"), (None, "zzz y")]
    docs = spark.createDataFrame(
        [(i, t, "q", 1) for i, t in texts], "doc_id long, text string, fp string, mark long"
    )
    got = [(i, c) for i, _, c in rows(simhash.near_duplicate_report(docs))]
    want = [(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 4), (5, 4), (6, 6)]
    assert sorted(got, key=repr) == sorted(want + [(None, None)] * 2, key=repr)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 4, 6, None]
    assert simhash.near_duplicate_report(docs.limit(0)).collect() == []


def test_repeated_survivor_is_one_row(spark):
    docs = spark.createDataFrame([(5, "a b"), (5, "a b"), (7, "a b")], "doc_id long, text string")
    assert rows(simhash.keep_first(docs)) == [(5, "a b")]


def test_no_column_name_clashes(spark):
    text = "one two three four five"
    rows_ = [(1, text), (2, text), (2, text), (3, "another text altogether here"), (None, None)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    names = ["__id", "__of", "__mark", "__times", "c0", "k0", "k1", "fp", "root", "i", "m", "a b", "x.y"]
    wide = df
    for name in names:
        wide = wide.withColumn(name, F.lit(name))
    kept = simhash.keep_first(wide)
    assert kept.columns == wide.columns
    got = kept.collect()
    assert {r["doc_id"] for r in got} == {1, 3, None} and len(got) == 3
    assert all(r[name] == name for r in got for name in names)
