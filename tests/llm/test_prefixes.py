import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from rxlens.llm import prefixes
from rxlens.llm.queries import LLM_ORACLES, LLM_QUERIES

NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string"


def digest(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, (role or "", text or "")))
    for conv_id, turns in own.items():
        own[conv_id] = [t[2] for t in sorted(turns, key=lambda t: (*t[:2], digest(t[2])))]
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        out[c] = base[:h] + turns[h:]
    return out


def expected(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(of) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in of if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        n = len(of), children.get(node, 0), leaves[node], saved[node]
        out.append((of[0], len(node), parent, *n, sha))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


def test_whole_table_equals_brute_force_and_sql(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = rows_of(LLM_QUERIES["op11_prefix_trie"](spark, sf_dir))
    assert got == expected(rebuilt([tuple(r) for r in table.collect()]))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    sql = LLM_ORACLES["op11_prefix_trie"]
    assert sorted(con.sql(f"SELECT {','.join(NAMES)} FROM ({sql})").fetchall(), key=repr) == got


@pytest.mark.parametrize("width, bits", [(8, 12), (1, 0), (3, 2)])
def test_block_width_and_chunks_do_not_show(spark, width, bits):
    rng = random.Random(width)
    rows = []
    for c in [*range(0, 60), -7, -100, 100, 5_000_000_000]:
        for turn in range(rng.choice([0, 1, 2, 7, 8, 9, 16, 17])):
            text = rng.choice("ab") if turn in (0, 9) else "same"
            rows.append((c, turn, ("user", "assistant")[turn % 2], text))
    df = spark.createDataFrame(rows, SCHEMA)
    turns = prefixes.turn_rows(df)
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role, text))
    assert rows_of(prefixes.trie(turns, width, bits)) == expected(own)
    assert rows_of(prefixes.trie(prefixes.shared_starts(turns), width, bits)) == expected(rebuilt(rows))


def test_hard_rows(spark):
    long = "é😀" * 200_000
    rows = [
        (1, None, None, None),
        (1, 0, "user", ""),
        (1, 0, "user", ""),
        (2, 5, "user", long),
        (2, 5, "user", "b"),
        (2, 5, "assistant", "b"),
        (3, None, None, None),
        (None, 0, "user", "lost"),
        (104, 1, "user", "a"),
        (104, 2, "us", "era"),
        *[(200, t, "user", "x") for t in range(100)],
        *[(c, t, "user", "x") for c in range(201, 240) for t in range(50)],
        *[(c, 0, "user", "only turn") for c in range(301, 330)],
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rebuilt(rows))
    assert rows_of(prefixes.trie_report(df)) == want
    clash = df.repartition(7)
    for name in ("pos", "id", "chars", "h", "base", "block", "depth", "k1", "t1", "turns", "at"):
        clash = clash.withColumn(name, F.lit("x"))
    assert rows_of(prefixes.trie_report(clash)) == want
    assert rows_of(prefixes.trie_report(df.limit(0))) == []
