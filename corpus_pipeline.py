"""A training corpus from raw documents: five stages over whole tables, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on what the stage before kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidedesk.llm import decontaminate, mixing, ngram_join, pii, toxicity
from tidedesk.llm.queries import MIX_WEIGHTS, OTHERS_WEIGHT
from tidedesk.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it learns from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that n-gram similarity links, the one with the smallest id stays."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; ``n_chars`` follows the text."""
    masked = pii.redacted(docs)
    size = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return masked if size is None else masked.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to the target weights of their sources and shuffled; sources that the weights do not name
    share one."""
    return mixing.mix(docs, MIX_WEIGHTS, seed=17, others=OTHERS_WEIGHT)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("mix_sources", mix_sources),
]

#: The trained classifier has no SQL form.
ORACLE_SQL = None


def run_with_report(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the last stage, and a written table of what each stage took and gave per source:
    ``stage, position, source, rows_in, rows_out``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    report = None
    for position, (name, stage) in enumerate(STAGES):
        given, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        sides = given.select("source", F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(
            docs.select("source", F.lit(0).alias("i"), F.lit(1).alias("o")))
        counts = sides.groupBy("source").agg(F.sum("i").alias("rows_in"), F.sum("o").alias("rows_out")).select(
            F.lit(name).alias("stage"), F.lit(position).alias("position"), "source", "rows_in", "rows_out")
        report = counts if report is None else report.unionByName(counts)
    return docs, materialize(report, "pipeline-report")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; the rows of the last."""
    return run_with_report(spark, sf_dir)[0]
