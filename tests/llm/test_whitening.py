"""Whitening against numpy's eigenvectors, and edge cases."""

import numpy as np
import pytest

pytest.importorskip("cohortix.llm")

from cohortix.llm import whitening  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, x int, d int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, "") for i, v in rows], SCHEMA)


def expected(rows, most=16):
    x = np.array([np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000 for _, v in rows])
    once = np.unique(x, axis=0)
    n, total = len(once), once.sum(0)
    c = once - total / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    out = {}
    for (i, _), row in zip(rows, x, strict=True):
        w = (row - total / n) @ v / np.sqrt(e)
        for k in range(len(e)):
            out.setdefault((i, k + 1), []).append((n, int(((n * row.astype(object) - total) ** 2).sum()), abs(w[k]), e[k] / np.trace(c.T @ c / n)))
    return out


@pytest.mark.parametrize("d", [1, 2, 5, 20])
def test_against_eigh(spark, d):
    rng = np.random.default_rng(d)
    rows = [(i, (rng.normal(size=d) * np.linspace(1, 9, d) - 40).tolist()) for i in range(300)]
    rows += [(i, rows[3][1]) for i in (3, 3, 900)] + [(None, rows[4][1])]
    bad = [(1000, None), (1001, [None] * d), (1002, [float("nan")] * d), (1003, [float("inf")] * d), (1004, [1e300] * d), (1005, [])]
    got = whitening.whiten(frame(spark, rows + bad).repartition(3)).collect()
    want = expected(rows)
    assert len(got) == len(rows) * min(d, 16)
    sign = {}
    for r in got:
        n, deviation, w, share = want[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - w) < 1e-6 and abs(r["explained"] / share - 1) < 1e-9 and r["identity_error"] < 1e-9
        sign.setdefault((r["vec_id"], r["component"]), set()).add(r["whitened"])
    assert all(len(s) == 1 for s in sign.values())


def test_one_fit_for_each_length_and_directions_without_variance(spark):
    rng = np.random.default_rng(0)
    two = [(i, rng.normal(size=2).tolist()) for i in range(40)]
    three = [(100 + i, [float(a), float(2 * a), 7.0]) for i, a in enumerate(rng.integers(-50, 50, 30))]
    one = [(500, [1.0, 2.0, 3.0, 4.0])] * 3
    got = whitening.whiten(frame(spark, two + three + one)).collect()
    of = lambda lo, hi: [r for r in got if lo <= r["vec_id"] < hi]
    assert len(of(0, 100)) == 80 and {r["component"] for r in of(100, 500)} == {1} and not of(500, 501)
    assert {r["n"] for r in of(100, 500)} == {len({v[0] for _, v in three})}
    assert all(abs(r["explained"] - 1) < 1e-12 for r in of(100, 500))


def test_large_entries_stay_exact(spark):
    rows = [(0, [2.0**54, 0.0]), (1, [-(2.0**54), 1.0]), (2, [3.0, 2.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()}
    assert got == {0: None, 1: None, 2: 384**2 + 192**2}
    assert whitening.deviations(np.array([[5, 7]]), 2, [10, 15]) == [1]


def test_jacobi_keeps_small_eigenvalues(spark):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    w = q * np.logspace(0, -5, 12)
    e, v = whitening.one_sided_jacobi(whitening.pivoted_cholesky(w @ w.T))
    assert np.abs(e / np.logspace(0, -10, 12) - 1).max() < 1e-5
    assert np.abs(np.abs(v.T @ q) - np.eye(12)).max() < 1e-5


def test_empty_table(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
