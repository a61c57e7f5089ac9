import hashlib
import zlib
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from rxlens.llm import manifest
from rxlens.llm.queries import LLM_ORACLES, LLM_QUERIES

NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes, arity):
    """Root of a list of digests, and the (left, right) steps of each of them."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place - place % arity :][:arity]
            steps[i].append(("".join(run[: place % arity]), "".join(run[place % arity + 1 :])))
        at = [place // arity for place in at]
        nodes = [h("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], steps


def expected(rows, arity=8):
    def leaf(r, text):
        return h("".join(map(encoded, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))

    made = []
    for r in rows:
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        later = lowered(r["text"]) if hit and r["text"] is not None else r["text"]
        tree = b"" if r["lang"] is None else b"=" + r["lang"].encode()
        none = r["doc_id"] is None
        made.append((tree, not none, r["doc_id"] or 0, leaf(r, r["text"]), leaf(r, later), r["doc_id"]))
    made.sort(key=lambda m: m[:4])
    groups = [list(g) for _, g in groupby(made, key=lambda m: m[0])]
    climbed = [climb([m[3] for m in g], arity) for g in groups]
    root, over = climb([c[0] for c in climbed], arity)
    out = []
    for g, (subroot, steps), above in zip(groups, climbed, over):
        for m, step in zip(g, steps):
            path = step + above
            digest = m[4]
            for left, right in path:
                digest = h(left + digest + right)
            proof = h("".join(left + right for left, right in path))
            out.append((m[5], m[3], subroot, root, proof, digest, digest == root))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


def test_whole_table_equals_brute_force_and_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = rows_of(LLM_QUERIES["op13_merkle_manifest"](spark, sf_dir))
    assert got == expected(docs.collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    sql = LLM_ORACLES["op13_merkle_manifest"]
    assert sorted(con.sql(f"SELECT {','.join(NAMES)} FROM ({sql})").fetchall(), key=repr) == got
    assert {g[-1] for g in got} == {True, False}


def made(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_heights_differ(spark):
    # 65 leaves: three levels; 64, 9, 8 and 1; nine groups need two levels above.
    sizes = {None: 65, "": 64, "a": 9, "b": 8, "c": 1, "d": 2, "é": 1, "z": 1, "zz": 3, "0": 1}
    rows, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n * 7919 % 1000 - 300, f"Text {n}", lang, "s", n))
    df = made(spark, rows).repartition(5)
    assert rows_of(manifest.manifest_report(df)) == expected(df.collect())


@pytest.mark.parametrize("arity", [2, 3])
def test_other_arities(spark, arity):
    rows = [(i, f"T{i}", "en" if i % 3 else "de", None, i) for i in range(21)]
    df = made(spark, rows)
    got = rows_of(manifest.manifest(df, changed=manifest.tampered, arity=arity))
    assert got == expected(df.collect(), arity)


def test_hard_rows(spark):
    rows = [
        (None, None, None, None, None),
        (None, "A", None, None, None),
        (1, "", "en", "", 0),
        (1, None, "en", "", 0),
        (1, "", "en", "", 0),
        (1, "", "en", "", 0),
        (2, "É" * 300_000 + "A", "en", "1:a", -5),
        (3, "x", "", "-", 1),
    ]
    df = made(spark, rows)
    want = expected(df.collect())
    clash = df
    for name in ("tree", "idx", "n", "digest", "__leaf", "__group", "__at", "path", "root"):
        clash = clash.withColumn(name, F.lit("x"))
    assert rows_of(manifest.manifest_report(clash)) == want
    assert rows_of(manifest.manifest_report(df.limit(0))) == []
    alone = made(spark, [(7, "ABC", "en", "s", 3)])
    assert rows_of(manifest.manifest_report(alone)) == expected(alone.collect())


def test_untouched_rows_verify(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert manifest.manifest(docs).filter("not verified").count() == 0


def test_no_python_on_the_executors(spark, sf_dir):
    plan = LLM_QUERIES["op13_merkle_manifest"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
