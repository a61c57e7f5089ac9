import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rxlens.llm import sharding
from rxlens.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (3, 3), (4, 2)])
def test_curve_visits_each_cell_and_steps_to_a_neighbour(spark, dims, bits):
    steps = [F.expr(f"cast(shiftright(id, {bits * i}) % {1 << bits} as int)") for i in range(dims)]
    cells = spark.range(1 << dims * bits).select(*[s.alias(f"x{i}") for i, s in enumerate(steps)])
    path = cells.withColumn("h", sharding.hilbert([F.col(f"x{i}") for i in range(dims)], bits))
    path = path.orderBy("h").collect()
    assert [r["h"] for r in path] == list(range(len(path)))
    for a, b in zip(path, path[1:]):
        assert sum(abs(a[i] - b[i]) for i in range(dims)) == 1


@pytest.mark.parametrize("part_rows", [20_000, 7])
def test_whole_table_obeys_its_law(spark, sf_dir, part_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.shard(docs, part_rows=part_rows).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert set(slots) == set(range(40)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = {
        r["doc_id"]: (len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
        for r in docs.collect()
    }
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == want


def test_shards_are_compact(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = sharding.shard(docs).join(docs.select("doc_id", "lang", "source"), "doc_id")
    for name in ("lang", "source"):
        of = placed.groupBy("shard").agg(F.countDistinct(name).alias("n")).agg(F.avg("n")).first()[0]
        every = docs.select(name).distinct().count()
        assert of < 0.75 * every


def test_steps_follow_whole_values(spark):
    urls = [f"https://a.example.com/same/start/{i:04d}" for i in range(640)]
    rows = [(u, i * 3, None if i % 5 == 0 else "x") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "u string, n long, c string").repartition(9)
    got = sharding.quantised(df, ["u", "n", "c"]).collect()
    for r in got:
        i = urls.index(r["u"])
        assert r["__step0"] == i * 32 // 640
        assert abs(r["__step1"] - i * 32 // 640) <= 1
        # A fifth of the rows is null and sorts before the only value.
        assert r["__step2"] == (0 if r["c"] is None else 128 * 32 // 640)


def test_shards_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total, columns = docs.count(), ["source", "lang", "n_chars"]
    stepped = sharding.quantised(docs, columns).collect()
    for i, name in enumerate(columns):
        at = sorted(stepped, key=lambda r: (r[name] is not None, r[name]))
        assert [r[f"__step{i}"] for r in at] == sorted(r[f"__step{i}"] for r in at)
        assert len({r[f"__step{i}"] for r in at}) > 2
    cell = {r["doc_id"]: sharding_cell(r) for r in stepped}
    got = sharding.shard(docs).collect()
    assert len({r["cell"] for r in got}) > 50
    by_cell = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["cell"] for r in by_cell] == sorted(r["cell"] for r in got)
    assert [r["shard"] for r in by_cell] == [rank * 40 // total for rank in range(total)]
    ranks = {c: n for n, c in enumerate(sorted(set(cell.values())))}
    seen = {}
    for r in got:
        seen.setdefault(cell[r["doc_id"]], set()).add(r["cell"])
    assert all(len(s) == 1 for s in seen.values()) and len(ranks) == len({r["cell"] for r in got})


def sharding_cell(row):
    return tuple(row[f"__step{i}"] for i in range(3))


def test_a_filter_on_two_columns_skips_shards(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = sharding.shard(docs).join(docs.select("doc_id", "lang", "source", "n_chars"), "doc_id")
    bounds = placed.groupBy("shard").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("source", "lang", "n_chars")]
    )
    hit = bounds.filter("min_lang <= 'fr' and max_lang >= 'fr' and min_source <= 'src7' and max_source >= 'src7'")
    assert hit.count() <= 16


def test_hard_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, cell long"
    hard = [(1, None, None, None, None, 1), (2, "", "en", "s", 3, 1), (2, "", "en", "s", 3, 1)]
    df = spark.createDataFrame(hard + [(None, "é", "fr", "t", 1, 0)], schema)
    got = sharding.shard_report(df).collect()
    assert sorted(Counter(r["shard"] for r in got).values()) == [1, 1, 1, 1]
    assert {r["size"] for r in got} == {16, 18} and {r["law"] for r in got} == {"rows"}
    assert sharding.shard_report(df.limit(0)).collect() == []


def test_no_python_on_the_executors(spark, sf_dir):
    plan = LLM_QUERIES["op9_hilbert_sharding"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
