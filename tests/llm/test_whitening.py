import math

import numpy as np
import pytest

from tests.conftest import TESTDATA
from tidedesk.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, whitened string"


@pytest.fixture
def make(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, "n", "w") for i, v in rows], SCHEMA)


def brute(rows, top=32):
    """Whitened values up to sign, by an eigendecomposition of the covariance matrix."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    c = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:top], u[:, ::-1][:, :top]
    return [i for i, _ in good], n, dev, np.abs(c @ u / np.sqrt(e)), e / np.trace(c.T @ c / n)


def check(df, rows, top=32):
    ids, n, dev, white, share = brute(rows, top)
    got = sorted(df.collect(), key=lambda r: (str(r["vec_id"]), r["component"], r["deviation"]))
    k = white.shape[1]
    assert len(got) == len(ids) * k and {r["n"] for r in got} == {n}
    want = sorted(((i, j + 1, dev[a], white[a, j], share[j]) for a, i in enumerate(ids) for j in range(k)), key=lambda r: (str(r[0]), r[1], r[2]))
    assert [(r["vec_id"], r["component"], r["deviation"]) for r in got] == [w[:3] for w in want]
    assert np.allclose([abs(r["whitened"]) for r in got], [w[3] for w in want], rtol=0, atol=1e-7)
    assert np.allclose([r["explained"] for r in got], [w[4] for w in want], rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    by_component = sorted(got, key=lambda r: (r["component"], str(r["vec_id"]), r["deviation"]))
    signed = np.array([r["whitened"] for r in by_component]).reshape(k, len(ids)).T
    assert np.abs(signed.T @ signed / n - np.eye(k)).max() < 1e-9


def sample(n, d, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * spread ** -np.arange(d) + rng.normal(size=d)
    return [(i, [float(c) for c in r]) for i, r in enumerate(x.astype(np.float32))]


def test_against_eigendecomposition(make):
    bad = [(900, None), (901, [None] * 6), (902, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (903, [float("inf")] * 6)]
    rows = sample(80, 6, 1) + [(3, [0.5] * 6), (3, [0.5] * 6), (None, [0.25] * 6)]
    df = make(rows + bad).repartition(5)
    check(whitening.whiten(df, whitening.fit(df)), rows)
    check(whitening.whiten(df, whitening.fit(df), top=2), rows, 2)


def test_ill_conditioned_rows(make):
    rows = [(i, [c * 2 ** 40, c * 3e5, a, b]) for i, (c, a, b) in enumerate(np.random.default_rng(2).normal(size=(60, 3)).tolist())]
    df = make(rows)
    model = whitening.fit(df)
    out = whitening.whiten(df, model)
    assert model.components.shape[1] >= 3 and out.first()["identity_error"] < 1e-4


def test_directions_without_variance(make):
    """A constant column and a repeated one: two components are left, both white."""
    rows = [(i, [a, a, 1.5, b]) for i, (a, b) in enumerate(np.random.default_rng(4).normal(size=(50, 2)).tolist())]
    df = make(rows)
    out = whitening.whiten(df, whitening.fit(df)).collect()
    assert len(out) == 100 and out[0]["identity_error"] < 1e-9
    assert abs(sum(r["explained"] for r in out if r["vec_id"] == 0) - 1) < 1e-9


def test_other_lengths_and_none(make):
    rows = sample(30, 3, 5)
    df = make(rows + [(50, [1.0, 2.0]), (51, []), (52, [1.0] * 9)])
    check(whitening.whiten(df, whitening.fit(df)), rows)
    for few in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]):
        df = make(few)
        assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_large_values(make):
    """Squared deviations beyond a long are null; entries beyond one saturate."""
    df = make([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [1e30, 2.0]), (4, [0.0, 0.5])])
    out = whitening.whiten(df, whitening.fit(df)).collect()
    assert {r["deviation"] for r in out} == {None} and all(math.isfinite(r["whitened"]) for r in out)
    small = make([(1, [2e6, 0.0]), (2, [-2e6, 1.0]), (3, [1.0, 2.0])])
    rows = [(1, [2e6, 0.0]), (2, [-2e6, 1.0]), (3, [1.0, 2.0])]
    assert {r["vec_id"]: r["deviation"] for r in whitening.whiten(small, whitening.fit(small)).collect()} == dict(zip(*brute(rows)[::2][:2]))


def test_given_table(spark):
    df = spark.read.parquet(f"{TESTDATA}/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(whitening.whiten(df, whitening.fit(df)), rows)
