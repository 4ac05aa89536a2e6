"""Every registered query against its SQL counterpart in DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from captide.suite import queries
from captide.suite.oracles import ORACLES
from captide.suite.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_suite_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, str(SF_DIR))
    columns = sorted(frame.columns)
    want = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(want.columns) == columns
    types = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    at = [want.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in at) for row in want.fetchall()]
    assert ordered(tuple(r) for r in frame.select(*columns).collect()) == ordered(expected)


def test_parts_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "_PART_ROWS", 50)
    cores = spark.sparkContext.defaultParallelism
    assert queries.spread(spark.range(0)).rdd.getNumPartitions() == cores
    for rows, of in ((1001, None), (7, spark.range(1001))):
        dealt = queries.spread(spark.range(rows), of)
        assert dealt.rdd.getNumPartitions() == 21
        assert sorted(r.id for r in dealt.collect()) == list(range(rows))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
