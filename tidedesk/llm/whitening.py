"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers (``floor(64 * c) + 1000000``), rows are centred at their exact mean, and Gram passes
over the table orthogonalise them: pass one factors the Gram matrix with a small shift on its diagonal, which
keeps it positive definite however ill-conditioned the rows are; later passes take the rows through triangular
solves by the factors found so far and factor the Gram matrix of what comes out. The composed factor R holds
all of the table that whitening needs: its right singular vectors are the components, its squared singular
values over n the eigenvalues of the covariance.

Each pass is one scan. A task keeps one Arrow batch and one d x d sum; sums leave it as one row per matrix
row and are added in Spark. The driver holds d x d matrices (d is at most ``MAX_DIM``), never rows.

Defined cases: a null vector, or one with a null or non-finite entry, is dropped; so are vectors of another
length than the table's most frequent one (ties: the longer), which have no place in one matrix. Repeated rows
and ids count as often as they stand, a null id is kept. Entries beyond the range of a long saturate. A
``deviation`` beyond the range of a long is null. Directions without variance have no whitened form and are
left out, so fewer than ``top`` components may come back: none for one row, or for an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, functions as F

from tidedesk.session import materialize

MAX_DIM = 4096
SCALE, OFFSET = 64, 1_000_000
#: Rows are worked on in blocks of so many entries.
BLOCK = 1 << 20


class Fit(NamedTuple):
    """``sums`` per dimension are exact; ``components`` has one unit column per component."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def integers(vectors: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Valid rows by length: ``{length: (row indices, matrix of longs)}``."""
    if not pa.types.is_large_list(vectors.type):
        vectors = vectors.cast(pa.large_list(vectors.type.value_type))
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1), np.int64)
    flat = vectors.flatten()  # without the entries of null rows
    values = np.asarray(pc.fill_null(flat.cast(pa.float64()), float("nan")), np.float64)
    sizes = np.maximum(lengths, 0)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for d in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        x = values[starts[rows][:, None] + np.arange(d)]
        fine = np.isfinite(x).all(axis=1)
        whole = np.clip(np.floor(x[fine] * SCALE), -2.0 ** 63, 2.0 ** 63 - 2048 - OFFSET).astype(np.int64)
        out[d] = rows[fine], whole + OFFSET
    return out


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    step = max(1, BLOCK // max(d, 1))
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            rows, x = integers(part.column(part.num_columns - 1)).get(d, (np.empty(0, np.int64), np.empty((0, d), np.int64)))
            if len(rows):
                yield part.column(0).take(pa.array(rows)), x


def totals(rows: DataFrame, vector: str) -> tuple[int, np.ndarray]:
    """Row count and exact sums per dimension, of the most frequent vector length."""
    schema = pa.schema([("d", pa.int64()), ("i", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                for d, (found, x) in integers(batch.slice(a, 4096).column(0)).items():
                    values = [len(found), *np.sum(x, axis=0, dtype=np.int64).tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d] * (d + 1)), pa.array(range(-1, d), pa.int64()), pa.array(values, pa.int64())], schema=schema)

    parts = rows.select(vector).mapInArrow(run, "d long, i long, v long")
    added = materialize(parts.groupBy("d", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")), "vector-sums")
    counts = added.filter((F.col("i") == -1) & (F.col("v") > 0)).orderBy(F.desc("v"), F.desc("d")).limit(1).collect()
    if not counts:
        return 0, np.empty(0, object)
    d, n = counts[0]["d"], int(counts[0]["v"])
    if d > MAX_DIM:
        raise ValueError(f"vectors of {d} dimensions; the driver's matrices hold at most {MAX_DIM}")
    sums = np.zeros(d, object)
    for r in added.filter((F.col("d") == d) & (F.col("i") >= 0)).collect():  # one row per dimension
        sums[r["i"]] = int(r["v"])
    return n, sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` in doubles: whole and fractional part of the mean are taken off one after the other."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums], np.float64)
    return (x - whole) - rest


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n * x - S) ** 2`` per row, exact."""
    d = x.shape[1]
    most = max((max(abs(n * int(hi) - s), abs(n * int(lo) - s)) for hi, lo, s in zip(x.max(0), x.min(0), sums)), default=0)
    if most * most * d < 2 ** 63 and n * int(np.abs(x).max(initial=0)) < 2 ** 62 and all(abs(s) < 2 ** 62 for s in sums):
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = [int(v) for v in ((n * x.astype(object) - sums) ** 2).sum(axis=1)]
    return [v if v < 2 ** 63 else None for v in exact]


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``a @ inverse(r)`` for an upper triangular ``r``: all rows of a block advance column by column."""
    q = np.empty_like(a)
    for j in range(len(r)):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(rows: DataFrame, vector: str, n: int, sums: np.ndarray, carry: Callable[[np.ndarray], np.ndarray], k: int) -> np.ndarray:
    """``A' A`` of the centred rows taken through ``carry`` to ``k`` columns, added up over tasks by matrix cell."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for _, x in _blocks(batches, d):
            a = carry(centred(x, n, sums))
            total += a.T @ a
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "r"])

    parts = rows.select(vector).mapInArrow(run, "i int, r array<double>")
    cells = parts.select("i", F.posexplode("r").alias("j", "v")).filter("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((k, k))
    for r in cells.collect():  # k (k + 1) / 2 cells
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with ``R' R = g + shift * I``; the shift grows until the factorisation holds."""
    step = shift or np.finfo(float).eps * max(np.trace(g), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift, step = shift + step, step * 10


def _root(g: np.ndarray) -> np.ndarray:
    """A square root of the last Gram matrix, near the identity unless the rows lack directions."""
    values, vectors = np.linalg.eigh(g)
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def fit(rows: DataFrame, vector: str = "embedding", passes: int = 3) -> Fit:
    """Components and eigenvalues after ``passes`` Gram passes (and one for the sums)."""
    n, sums = totals(rows, vector)
    d = len(sums)
    none = Fit(n, sums, np.empty((d, 0)), np.empty(0), 0.0)
    if not n or not d:
        return none
    eps, factors = np.finfo(float).eps, []
    for i in range(passes):
        g = gram(rows, vector, n, sums, lambda a, found=tuple(factors): reduce(solved, found, a), d)
        if i == 0 and not np.trace(g) > 0:
            return none
        shift = 11 * d * (d + 1) * eps * np.trace(g) if i == 0 else 0.0
        factors.append(_factor(g, shift) if i + 1 < passes else _root(g))
    r = reduce(lambda low, high: high @ low, factors)
    _, singular, right = np.linalg.svd(r)
    kept = singular > singular[0] * d * 8 * eps
    values = singular ** 2 / n
    return Fit(n, sums, right[kept].T.copy(), values[kept], float(values.sum()))


def whiten(rows: DataFrame, model: Fit, key: str = "vec_id", vector: str = "embedding", top: int = 32) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component up to ``top``."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    k = min(top, model.components.shape[1])
    spark = rows.sparkSession
    if not k:
        return spark.createDataFrame([], schema)
    through = model.components[:, :k] / np.sqrt(model.eigenvalues[:k])
    error = float(np.abs(gram(rows, vector, model.n, model.sums, lambda a: a @ through, k) / model.n - np.eye(k)).max())
    share = model.eigenvalues[:k] / model.trace
    n, sums = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, len(sums)):
            m = len(ids)
            w = centred(x, n, sums) @ through
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector")).mapInArrow(run, schema)
