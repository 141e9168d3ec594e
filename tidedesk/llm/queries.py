"""One query per operator, over whole tables; ``SQL`` holds DuckDB twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidedesk.llm import (
    cross_entropy, decontaminate, html, infill, licenses, mixing, ngram_join, pii, sql, substring, toxicity, warc, whitening, winnow,
)
from tidedesk.session import materialize, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL = sql.TWINS


def query(fn):
    """Register a function under its name; the session is put in UTC first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op1_warc_transactions(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archive(warc.with_roles(table(spark, d, "pages")), path)
    # written without bodies, so that archives are parsed once and not for each kind of record
    records = materialize(warc.measured(warc.read_archives(spark, path)), "warc-records")
    return warc.resolve_revisits(materialize(warc.page_roles(warc.assemble(records)), "warc-roles"))


#: Target shares: the hot source is held to 15 %, the others share the rest in three steps.
#: Sources that the table does not name, and documents without one, share ``OTHERS_WEIGHT``.
MIX_WEIGHTS = {"src0": 15.0, **{f"src{i}": (2.0, 4.0, 6.0)[i % 3] for i in range(1, 20)}}
OTHERS_WEIGHT = 2.0


@query
def op3_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), MIX_WEIGHTS, seed=17, others=OTHERS_WEIGHT)


@query
def op8_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.detect(table(spark, d, "documents"))


@query
def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))


@query
def op6_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.scan(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op4_main_text(spark: SparkSession, d: str) -> DataFrame:
    return html.extract(table(spark, d, "pages"))


@query
def op5_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.join(table(spark, d, "documents"))


@query
def op7_cross_entropy(spark: SparkSession, d: str) -> DataFrame:
    return cross_entropy.score(table(spark, d, "documents"), table(spark, d, "benchmark"), words="both")


@query
def op9_winnowing(spark: SparkSession, d: str) -> DataFrame:
    return winnow.compare_with_edits(table(spark, d, "documents"))


@query
def op2_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring.deduplicate(table(spark, d, "documents")).drop("kept")


@query
def op11_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents"))


@query
def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@query
def op13_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return infill.digests(infill.transform(table(spark, d, "documents")))
