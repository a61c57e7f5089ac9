import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from rxlens.llm import decontam
from rxlens.llm.arrow import slices
from rxlens.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.conftest import rows

NAME = "op5_benchmark_decontamination"


def test_whole_tables_match_their_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    relation = con.sql(LLM_ORACLES[NAME])
    columns = relation.columns
    got = rows(LLM_QUERIES[NAME](spark, sf_dir).select(*columns))
    assert got == sorted(relation.fetchall(), key=repr) and any(r[-1] for r in got)


def tables(spark):
    long = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [
            (1, None, 1),
            (None, "a b c", 1),
            (2, f"x {long} eleven y", 1),
            (2, "one, TWO three! four five six seven eight nine ten", 1),
            (3, "b c d", 1),
            (3, "b c d", 1),
            (4, "q é", 1),
            (5, " ".join(reversed(long.split())), 1),
        ],
        "doc_id long, text string, n_hit long",
    )
    items = [(1, f"{long} eleven"), (10, "b c"), (9, "c"), (None, "É? q"), (7, None), (8, "..."), (11, "c")]
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_hard_rows(spark):
    docs, items = tables(spark)
    got = rows(
        decontam.contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items")
    )
    short = ["10", "11", "9"]
    want = [(1, 0, 0, 0, []), (None, 3, 2, 3, short), (2, 13, 11, 1, ["1"]), (2, 10, 10, 1, ["1"])]
    want += [(3, 3, 2, 3, short)] * 2 + [(4, 2, 0, 0, []), (5, 10, 0, 0, [])]
    assert got == sorted(want, key=repr)
    left = decontam.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4, 5]


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert decontam.contamination_report(docs.limit(0), items).collect() == []
    assert not any(r["contaminated"] for r in decontam.contamination(docs, items.limit(0)).collect())


def test_proximity_takes_any_order(spark):
    docs, items = tables(spark)
    windows = decontam.window_words(items.filter("item_id = 1"))
    index = decontam.build_index(docs, windows, runs_only=False)
    near = decontam.proximity_matches(index, windows, 9).join(index, "row")
    assert {r["doc_id"] for r in near.collect()} == {2, 5}


def test_no_column_name_clashes(spark):
    item = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame(
        [(1, f"so {item} then"), (2, "clean words"), (2, "clean words"), (None, None), (None, item)],
        "doc_id long, text string",
    )
    names = ["__id", "__of", "__mark", "mark", "b0", "c0", "row", "x.y", "a b"]
    wide = df
    for name in names:
        wide = wide.withColumn(name, F.lit(name))
    items = spark.createDataFrame([(1, item, "x")], "item_id long, text string, __id string")
    left = decontam.drop_contaminated(wide, items)
    assert left.columns == wide.columns
    got = left.collect()
    assert sorted([r["doc_id"] for r in got], key=str) == [2, 2, None]
    assert all(r[name] == name for r in got for name in names)


def test_parts_of_a_batch_and_forgotten_words_change_nothing(spark, monkeypatch):
    docs, benchmark = tables(spark)
    whole = rows(decontam.contamination(docs.coalesce(1), benchmark))
    monkeypatch.setattr(decontam, "ROWS", 2)
    monkeypatch.setattr(decontam, "MAX_KNOWN", 1)
    assert rows(decontam.contamination(docs.coalesce(1), benchmark)) == whole
    batch = pa.RecordBatch.from_pydict({"a": list(range(5))})
    assert [part["a"].to_pylist() for part in slices([batch], 2)] == [[0, 1], [2, 3], [4]]
