"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of the lower-cased text, hashed to ``2**bits`` buckets. Their
log-count ratios come from how many toxic and other training texts hold them; the buckets whose
ratio is surest (ratio over its standard error) stay, and a logistic regression (Spark ML) is fitted
on presence times ratio. Only texts reach a score.

The fit uses at most ``max_train`` labelled rows, those with the smallest hash of their id: a
documented bound that lets the labels be broadcast, so that no text is shuffled.

Defined cases: a null or empty text has no features and gets the score of the intercept; a label
row without id or label is not used; of repeated label rows the largest label counts; a training
set with one class or none gives that class's share (0 if none) for every text; repeated documents
are scored one by one. Other input columns are ignored by :func:`score`, kept by :func:`keep_clean`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.session import materialize

THRESHOLD = 0.7
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 22
    keep: int = 4096
    min_docs: int = 5
    smoothing: float = 1.0
    max_train: int = 20_000
    reg: float = 0.0002
    folds: int = 3
    held_out: int = 1


@dataclass(frozen=True)
class Model:
    """``buckets`` sorted; ``weights`` already hold coefficient times ratio."""

    settings: Settings
    intercept: float
    buckets: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))


def fold(key: Column, folds: int = 3) -> Column:
    return F.crc32(key.cast("string")) % folds


def ngram_buckets(text: str | None, settings: Settings) -> np.ndarray:
    """Buckets of all n-grams, in order and with repeats; a text shorter than n has none of that n."""
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, rolled = [], points + np.uint64(1)
    shift = np.uint64(64 - settings.bits)
    for n in range(2, max(settings.orders) + 1):
        if len(points) < n:
            break
        rolled = rolled[:-1] * _MULT + points[n - 1:] + np.uint64(1)
        if n in settings.orders:
            mixed = rolled ^ (rolled >> np.uint64(29))
            out.append(((mixed * _MIX) >> shift).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``text, toxic`` of the bounded training sample, written down once."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.filter(fold(F.col("doc_id"), settings.folds) != settings.held_out)
    sample = (
        known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_train)
        .select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    return materialize(rows.select("text", F.col("_toxic").alias("toxic")), "toxicity-train")


def _bucket_counts(rows: DataFrame, settings: Settings) -> DataFrame:
    """``bucket, pos, neg``: how many toxic and other texts hold the bucket."""
    size = 1 << settings.bits

    def count(batches):
        held = np.zeros((2, size), np.int32)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                held[int(toxic.as_py() > 0), np.unique(ngram_buckets(text.as_py(), settings))] += 1
        some = np.flatnonzero(held.any(axis=0))
        for part in np.array_split(some, max(1, len(some) // 100_000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(held[1, part].astype(np.int64)), pa.array(held[0, part].astype(np.int64))],
                ["bucket", "pos", "neg"])

    parts = rows.select("text", "toxic").mapInArrow(count, "bucket long, pos long, neg long")
    return parts.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from the labelled rows outside the held-out fold."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector, VectorUDT

    rows = training_rows(docs, labels, settings)
    got = rows.agg(F.count("*"), F.sum((F.col("toxic") > 0).cast("long"))).first()
    n, n_pos = got[0], got[1] or 0
    if n == 0 or n_pos in (0, n):
        share = n_pos / n if n else 0.0
        return Model(settings, 30.0 if share else -30.0)
    a = settings.smoothing
    p, q = F.col("pos") + a, F.col("neg") + a
    ratio = F.log(p / (n_pos + 2 * a)) - F.log(q / (n - n_pos + 2 * a))
    chosen = (
        _bucket_counts(rows, settings).filter(F.col("pos") + F.col("neg") >= settings.min_docs)
        .withColumn("ratio", ratio).withColumn("sure", F.abs("ratio") / F.sqrt(1 / p + 1 / q))
        .orderBy(F.desc("sure"), "bucket").limit(settings.keep).select("bucket", "ratio").collect()
    )
    chosen.sort(key=lambda r: r["bucket"])
    buckets = np.array([r["bucket"] for r in chosen], np.int64)
    ratios = np.array([r["ratio"] for r in chosen])
    if not len(buckets):
        return Model(settings, float(np.log(n_pos / (n - n_pos))))
    width = len(buckets)

    def features(text: str | None) -> SparseVector:
        at = np.flatnonzero(np.isin(buckets, ngram_buckets(text, settings), kind="sort"))
        return SparseVector(width, at, ratios[at])

    as_vector = F.udf(features, VectorUDT())
    vectors = rows.select(as_vector("text").alias("features"), (F.col("toxic") > 0).cast("double").alias("label"))
    vectors = materialize(vectors, "toxicity-vectors")
    trained = LogisticRegression(regParam=settings.reg, elasticNetParam=0.0, standardization=False, maxIter=60).fit(vectors)
    return Model(settings, float(trained.intercept), buckets, trained.coefficients.toArray() * ratios)


def _table(model: Model) -> np.ndarray:
    """For each bucket its place among the weights, or the number of weights where it has none."""
    place = np.full(1 << model.settings.bits, len(model.buckets), np.int16)
    place[model.buckets] = np.arange(len(model.buckets))
    return place


def score_text(text: str | None, model: Model, place: np.ndarray) -> float:
    hits = place[ngram_buckets(text, model.settings)]
    present = np.unique(hits[hits < len(model.weights)])
    z = model.intercept + float(model.weights[present].sum())
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))))


def _scores(docs: DataFrame, model: Model):
    """A pandas UDF from text to score; the broadcast holds ``keep`` weights and builds a table of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        place = _table(known)
        for part in parts:
            yield part.map(lambda t: score_text(t if isinstance(t, str) else None, known, place)).astype("float64")

    return F.pandas_udf(run, "double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    s = model.settings
    return docs.select(
        "doc_id", (F.coalesce(fold(F.col("doc_id"), s.folds), F.lit(0)) == s.held_out).alias("held_out"),
        _scores(docs, model)("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, all columns as they were."""
    scored = docs.select(F.struct(*docs.columns).alias("row"), _scores(docs, model)("text").alias("score"))
    return scored.filter(F.col("score") < THRESHOLD).select("row.*")
