"""Operator queries against their SQL twins in DuckDB, and all of them for shape and determinism."""

import os

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import TESTDATA
from tidedesk.llm.queries import QUERIES, SQL

SF = f"{TESTDATA}/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def canon(v):
    return round(v, 9) if isinstance(v, float) else v


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(SQL))
def test_same_result(spark, duck, name):
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == order
    got = sorted((tuple(canon(r[c]) for c in order) for r in df.collect()), key=str)
    assert got == sorted((tuple(canon(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=str)


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "pii", "mix_sources"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        from tidedesk.session import materialize

        docs = materialize(stage(spark, docs, SF), f"stage-{i}")
        sizes.append(docs.count())
        if i < 4:
            assert docs.columns == columns
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[4] == sizes[3]
    assert docs.columns == [*columns, "copy", "shuffle_key"]
    assert corpus_pipeline.run(spark, SF).count() == sizes[5]
