import math

import numpy as np
import pytest

from furrow.llm import whitening as W
from tests.conftest import rows

SCHEMA = "vec_id bigint, embedding array<float>, component string"


def matrix(a, b):
    return np.diag(a) + np.diag(b, 1)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 60])
def test_bidiagonal(n):
    rng = np.random.default_rng(n)
    r = np.triu(rng.normal(size=(n, n)))
    a, b, v = W.bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(n), atol=1e-13)
    m = matrix(a, b)
    assert np.allclose(v @ m.T @ m @ v.T, r.T @ r, atol=1e-11)


def test_singular_values_keep_relative_accuracy():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 120):
        a, b = rng.normal(size=n), rng.normal(size=n - 1)
        assert np.allclose(W.dqds(a, b), np.linalg.svd(matrix(a, b), compute_uv=False), atol=1e-13 * 10)
    # graded over 100 orders of magnitude: the determinant gives the product of all values
    a, b = 10.0 ** -np.arange(0, 101, 10.0), 10.0 ** -np.arange(5, 101, 10.0)
    got = W.dqds(a, b)
    assert np.allclose(np.log(got).sum(), np.log(a).sum(), rtol=1e-13) and (got > 0).all()
    assert list(W.dqds(np.zeros(3), np.zeros(2))) == [0, 0, 0]
    assert np.allclose(W.dqds(np.array([1.0, 0.0, 2.0]), np.array([1.0, 1.0])), np.linalg.svd(matrix([1.0, 0.0, 2.0], [1.0, 1.0]), compute_uv=False), atol=1e-14)
    assert np.allclose(W.dqds(np.ones(30), np.zeros(29)), 1)


@pytest.mark.parametrize("case", ["random", "close", "equal", "split", "deficient"])
def test_directions(case):
    rng = np.random.default_rng(5)
    n = 30
    values = {"random": rng.uniform(1, 9, n), "close": np.array([5 + 1e-9 * k for k in range(6)] + [1 + k / 50 for k in range(n - 6)]),
              "equal": np.array([4.0] * 6 + [1.0] * (n - 6)), "split": np.arange(1.0, n + 1), "deficient": np.array([3.0, 2.0, 1.0] + [0.0] * (n - 3))}[case]
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    r = np.linalg.qr(np.diag(values) @ q.T, mode="r") if case != "split" else np.diag(values)
    e, v, trace = W.principal(r, 10, 8)
    want = np.sort(values**2)[::-1][:8] / 10
    want = want[want > 0]
    assert np.allclose(e, want, rtol=1e-12) and math.isclose(trace, (values**2).sum() / 10, rel_tol=1e-12)
    assert np.abs(v.T @ v - np.eye(len(want))).max() < 1e-12
    assert np.abs(r.T @ (r @ v) / 10 - v * e).max() < 1e-12 * want[0] * 10


def plain(data):
    """Whitened columns of the plain covariance's eigenvectors, absolute values."""
    x = np.floor(1024 * np.array([r[1] for r in data], dtype=np.float32).astype(float)) + 100000
    c = x - x.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    e, v = e[::-1], v[:, ::-1]
    k = min(8, int((e > 1e-9 * e[0]).sum()))
    return x.astype(np.int64), np.abs(c @ v[:, :k] / np.sqrt(e[:k])), e[:k] / e.sum()


def test_as_plain_covariance(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_BYTES", 1)
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(12, 12)) * 10.0 ** -np.arange(12.0)[:, None] ** 0.5
    good = [(k, (rng.normal(size=12) @ mix).astype(np.float32).tolist(), "x") for k in range(300)]
    good += [(None, good[0][1], None), (5, good[5][1], "x")]
    bad = [(900, None, "x"), (901, [None] + good[1][1][1:], "x"), (902, [float("nan")] + good[1][1][1:], "x"), (903, [float("-inf")] + good[1][1][1:], "x")]
    df = spark.createDataFrame(good + bad + [(950, [1.0, 2.0], "x"), (951, [3.0, 7.0], "x"), (952, [], "x"), (953, [2.5], "y")], SCHEMA).repartition(7)
    got = W.whiten(df).collect()
    x, white, explained = plain(good)
    n, s = len(x), x.sum(axis=0)
    twelve = [r for r in got if r["n"] == n]
    assert len(twelve) == 8 * n and {r["n"] for r in got} == {n, 2}
    by_id = {}
    for r in twelve:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    for k, row in enumerate(good):
        for c in range(8):
            for r in by_id[row[0]][c + 1]:
                assert abs(abs(r["whitened"]) - white[k, c]) < 1e-7 and int(r["deviation"]) == int(((n * x[k] - s) ** 2).sum())
                assert math.isclose(r["explained"], explained[c], rel_tol=1e-9) and r["identity_error"] < 1e-9
    assert {r["vec_id"]: (r["component"], int(r["deviation"]), abs(round(r["whitened"], 9)), r["explained"]) for r in got if r["n"] == 2} == {
        950: (1, 2048**2 + 5120**2, 1.0, 1.0), 951: (1, 2048**2 + 5120**2, 1.0, 1.0)}


def test_few_rows_and_none(spark):
    assert rows(W.whiten(spark.createDataFrame([], SCHEMA))) == []
    assert rows(W.whiten(spark.createDataFrame([(1, [1.0, 2.0], "x"), (2, [1.0, 2.0], "x")], SCHEMA))) == []
    three = [(k, [float(v) for v in np.eye(8)[k]], "x") for k in range(3)]  # two equal variances
    got = W.whiten(spark.createDataFrame(three, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2} and all(r["identity_error"] < 1e-9 for r in got)


def test_sums_beyond_64_bits():
    x = np.array([[1 << 42, 3], [5, 1 << 42]])
    n, sums = 1 << 30, [(1 << 71) + 1, 7]
    d = W.scaled_centred(x, n, sums)
    assert W.deviations(d) == [(n * (1 << 42) - sums[0]) ** 2 + (n * 3 - 7) ** 2, (n * 5 - sums[0]) ** 2 + (n * (1 << 42) - 7) ** 2]
