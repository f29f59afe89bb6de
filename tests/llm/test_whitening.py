import math

import numpy as np
import pytest

from meterline.llm import whitening
from meterline.llm.queries import op13_whitening
from tests.conftest import SF001
from tests.llm.helpers import stored

SCHEMA = "vec_id long, embedding array<double>, label int, x long, dim int, slot int, v long"


def brute(rows):
    """{(vec_id, component): (n, deviation, whitened, explained)} by numpy's own
    eigendecomposition; components by length."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for dim in {len(v) for _, v in usable}:
        mine = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in usable if len(v) == dim]
        fit = sorted({tuple(x) for _, x in mine})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit]).reshape(n, dim)
        e, v = np.linalg.eigh(y.T @ y / n)
        for i, x in mine:
            off = [n * a - s for a, s in zip(x, sums)]
            z = (np.array(off) / n) @ v[:, ::-1]
            for c in range(min(16, dim)):
                if e[::-1][c] > 1e-9 * e.sum():
                    out.append((i, c + 1, n, sum(o * o for o in off), abs(z[c]) / math.sqrt(e[::-1][c]),
                                e[::-1][c] / e.sum()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def check(df, rows):
    got = sorted(df.collect(), key=lambda r: (r["vec_id"] is not None, r["vec_id"] or 0, r["component"]))
    want = brute(rows)
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got] == [w[:4] for w in want]
    for r, w in zip(got, want):
        assert abs(r["whitened"]) == pytest.approx(w[4], rel=1e-7, abs=1e-7)
        assert r["explained"] == pytest.approx(w[5], rel=1e-9) and r["identity_error"] < 1e-9


def test_query_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    check(op13_whitening(spark, SF001), rows)


def test_awkward_vectors(spark):
    rnd = np.random.default_rng(4)
    low = rnd.normal(size=(3, 20)) * 8
    rows = [(i, (rnd.normal(size=20) * np.linspace(5, 1, 20)).tolist()) for i in range(200)]
    rows += [(i, [0.5] * 20) for i in range(200, 300)]                       # one vector many times
    rows += [(300 + i, np.round(rnd.normal(size=3) @ low).tolist() + [7.0] * 4) for i in range(60)]   # rank 3
    rows += [(400, None), (401, []), (402, [None] * 20), (403, [math.nan] * 20), (404, [math.inf] * 20),
             (None, [1.0] * 20), (5, [2.0] * 20), (405, [1.0, 2.0])]         # a length with one vector
    low_rank = [r for r in rows if r[1] is not None and len(r[1]) == 24]
    assert np.linalg.matrix_rank(np.array([v for _, v in low_rank])) >= 3
    at = stored(spark, "whiten", embeddings=spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], SCHEMA))
    check(op13_whitening(spark, at), rows)


def test_cholesky_and_jacobi_on_a_graded_matrix():
    rnd = np.random.default_rng(8)
    q, _ = np.linalg.qr(rnd.normal(size=(30, 30)))
    a = (q * np.logspace(6, -2, 30)) @ q.T
    a = (a + a.T) / 2
    factor = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, rtol=0, atol=1e-9)
    e, v = whitening.one_sided_jacobi(factor)
    assert np.allclose(e, np.logspace(6, -2, 30), rtol=1e-6) and np.all(np.diff(e) <= 0)
    assert np.allclose(v.T @ v, np.eye(30), atol=1e-13)
    flat = np.outer([1.0, 2.0, 2.0], [1.0, 2.0, 2.0])
    assert whitening.pivoted_cholesky(flat).shape == (3, 1)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    met = [tuple(sorted(p)) for i, j in whitening.rounds(7) for p in zip(i, j)]
    assert sorted(met) == [(a, b) for a in range(7) for b in range(a + 1, 7)]


def test_deviations_are_exact_or_null():
    centre = whitening.Centre(10 ** 9, [10 ** 15 + 3, 10 ** 15 - 8])
    x = np.array([[10 ** 6, 10 ** 6], [10 ** 6 + 1, 10 ** 6 - 2], [10 ** 6 + 2, 10 ** 6 + 2], [2 ** 40, 0]])
    exact = [sum((centre.n * int(a) - s) ** 2 for a, s in zip(r, centre.sums)) for r in x]
    assert centre.deviations(x) == [v if v < 2 ** 63 else None for v in exact]
    assert None in centre.deviations(x) and centre.deviations(x)[2] is not None


def test_empty_table(spark):
    at = stored(spark, "nowhiten", embeddings=spark.createDataFrame([], SCHEMA))
    assert op13_whitening(spark, at).count() == 0
