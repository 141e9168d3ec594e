"""Every registered query against its SQL twin in DuckDB, at the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA
from tidedesk.plans import oracle
from tidedesk.plans.catalog import QUERIES

SF = f"{TESTDATA}/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(canon(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = table(df.columns, df.collect())
    cur = duck.execute(ORACLE[name])
    assert got == table([c[0] for c in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 9
