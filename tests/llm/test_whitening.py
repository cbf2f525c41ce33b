import numpy as np
import pytest

from tilelake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string"


def plain(rows, components=32):
    """Straight from the definition, for rows of one length."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v, _ in rows], object)
    n, s = len(x), x.sum(axis=0)
    y = np.array([[float(v) for v in r] for r in (n * x - s)]) / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return {"n": n, "deviation": [int(v) for v in ((n * x - s) ** 2).sum(axis=1)], "whitened": y @ u / np.sqrt(e), "explained": e / np.trace(cov), "cov": cov, "axes": u}


def test_against_the_definition(spark):
    rng = np.random.default_rng(0)
    mix = rng.normal(size=(12, 12))
    good = [(i, (rng.normal(size=12) @ mix).tolist(), "x") for i in range(500)] + [(i, [0.5] * 12, "copy") for i in range(500, 750)]
    bad = [(1000, None, "x"), (1001, [None] + [1.0] * 11, "x"), (1002, [float("nan")] * 12, "x"), (1003, [float("inf")] * 12, "x"), (1004, [], "x")]
    found = whitening.whitened(spark.createDataFrame(good + bad, SCHEMA).repartition(5), components=8).toPandas()
    want = plain(good, 8)
    assert len(found) == 750 * 8 and set(found.n) == {750} and found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    z = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((z * want["whitened"]).sum(axis=0))
    assert np.allclose(z * sign, want["whitened"], atol=1e-7)
    assert found[found.component == 1].sort_values("vec_id").deviation.astype(int).tolist() == want["deviation"]
    assert np.allclose(found[found.vec_id == 3].sort_values("component").explained, want["explained"])


def test_lengths_apart_flat_and_large(spark):
    rows = [(1, [1.0, 2.0], "x"), (2, [3.0, 2.0], "x"), (None, [1.0, 2.0, 3.0], "x"), (3, [3e30, -3e30, 0.0], "x"), (3, [3e30, -3e30, 0.0], "x"), (4, [1.0] * 5, "x")]
    found = {(r.vec_id, r.component): r for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k[0] for k in found} == {1, 2, None, 3, 4} and found[(1, 1)].n == 2 and found[(None, 1)].n == 3 and found[(4, 5)].n == 1
    assert abs(abs(found[(1, 1)].whitened) - 1) < 1e-12 and found[(1, 2)].whitened is None and found[(4, 1)].whitened is None
    assert found[(1, 1)].deviation == 128**2 and found[(1, 1)].explained == 1 and found[(4, 1)].explained == 0
    assert found[(3, 1)].deviation > 2**63 and found[(1, 1)].identity_error < 1e-9


def test_empty(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None, "x"), (2, [], "x")], SCHEMA)).count() == 0


@pytest.mark.parametrize("values", [[0, 1, -1], [2**52, -(2**52), 5], [2**32, 2**32 - 1, -(2**33) - 7]])
def test_exact_sums(values):
    x = np.array(values * 1000, np.int64)[:, None]
    assert whitening.exact_sum(x) == [sum(values) * 1000]
    mean = whitening.Mean(len(x), whitening.exact_sum(x))
    assert mean.deviation(x[:3]) == [(len(x) * v - sum(values) * 1000) ** 2 for v in values]
