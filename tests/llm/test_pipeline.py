"""Stages of the pipeline over rows that the given tables do not hold: repeated and null ids, foreign sources, clashing columns."""

import pytest

import corpus_pipeline
from tests.conftest import TESTDATA
from tidedesk.session import materialize

SF = f"{TESTDATA}/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
CLEAN = ["the quiet river runs along the old stone wall near town", "seven gardens bloom where the eastern road turns to gravel",
         "our library keeps maps of every island in the northern sea"]


@pytest.fixture
def with_clean(spark):
    """The given documents with rows added: ids that repeat with other texts, null ids, foreign and null sources."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(3, CLEAN[0], "en", "wiki", len(CLEAN[0])), (3, CLEAN[1], "en", None, len(CLEAN[1])), (None, CLEAN[2], "en", "wiki", len(CLEAN[2])),
             (None, None, "en", "wiki", 0), (90_001, "", None, None, 0)]
    return docs.unionByName(spark.createDataFrame(extra, docs.schema)), {e[1] for e in extra}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:4]])
def test_filtering_stages_keep_clean_rows(spark, with_clean, name):
    docs, texts = with_clean
    out = STAGES[name](spark, docs, SF)
    assert out.columns == docs.columns
    kept = out.collect()
    got = [(r.doc_id, r.text) for r in kept if r.text in texts]
    # the given table holds empty texts of its own, which no stage takes for copies of one another
    assert {(3, CLEAN[0]), (3, CLEAN[1]), (None, CLEAN[2]), (None, None), (90_001, "")} <= set(got)
    assert len(kept) <= docs.count()


def test_mixing_keeps_every_source(spark, with_clean):
    docs, _ = with_clean
    grown = docs
    for _ in range(4):
        grown = grown.unionByName(docs.filter("source is null or source = 'wiki'"))
    out = STAGES["mix_sources"](spark, materialize(grown, "grown"), SF)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    foreign = docs.drop("source").selectExpr("*", "'elsewhere' AS source")
    assert STAGES["mix_sources"](spark, foreign, SF).count() > 0.7 * docs.count()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert STAGES[name](spark, docs, SF).count() == 0


def test_report_tells_what_each_stage_took_and_gave(spark):
    docs, report = corpus_pipeline.run_with_report(spark, SF)
    rows = report.collect()
    assert [n for n, _ in sorted({(r.stage, r.position) for r in rows}, key=lambda x: x[1])] == [n for n, _ in corpus_pipeline.STAGES]
    total = {p: (sum(r.rows_in for r in rows if r.position == p), sum(r.rows_out for r in rows if r.position == p)) for p in range(5)}
    assert total[0][0] == spark.read.parquet(f"{SF}/documents.parquet").count() and total[4][1] == docs.count()
    assert all(total[p][1] == total[p + 1][0] for p in range(4)) and all(total[p][1] <= total[p][0] for p in range(4))
