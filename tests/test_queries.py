"""Every registered query against its SQL, on whole tables of the smallest scale."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from rxlens.checks import ORACLES, QUERIES
from rxlens.sources.star import StarTables

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, sf_dir, name):
    df = entry_module.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    relation = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    at = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
    assert got and got == want


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["channel", "state"]


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


def test_oracles_read_whole_tables():
    for name, text in entry_module.oracle_sql().items():
        limits = re.findall(r"LIMIT\s+\d+", text, re.I)
        assert not limits or name.startswith("top_"), name


def test_schema_is_read_once_per_session(spark, sf_dir):
    t = StarTables(spark, sf_dir)
    assert t.table("orders").schema is not None
    assert t.table("orders").dtypes == spark.read.parquet(f"{sf_dir}/orders.parquet").dtypes
