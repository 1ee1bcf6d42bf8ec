"""The linear solver on designs that coordinate descent alone does not finish on: collinear columns of very unlike scales."""

import numpy as np
import pytest

from plinth.operators import models as mo


def moments(x: np.ndarray, y: np.ndarray) -> mo.Moments:
    m = np.c_[x, y]
    shift = m[:100].mean(0)
    d = m - shift
    return mo.Moments(len(m), d.sum(0), d.T @ d, shift)


def design(n: int = 1200):
    r = np.random.default_rng(0)
    few, wide = r.integers(1, 8, n).astype(float), r.lognormal(10, 1, n)
    x = np.c_[few, few**2, few * 3 + r.normal(0, 1e-3, n), few > 3, wide, wide**2, wide / few, wide, r.normal(size=(n, 8)),
              np.eye(6)[r.integers(0, 6, n)], 2000 + r.integers(0, 7, n), np.ones(n)]
    return x, 0.3 * few + x[:, 8] + np.log(wide) + r.normal(0, 0.1, n)


@pytest.mark.parametrize("kind", ["lasso", "elasticnet"])
def test_optimality_conditions_hold_on_collinear_columns(kind):
    x, y = design()
    m = moments(x, y)
    mean = m.s / m.n
    cov = m.g / m.n - np.outer(mean, mean)
    a, b, near = cov[:-1, :-1], cov[:-1, -1], None
    spread = np.sqrt(np.maximum(np.diag(a), 1e-300))
    for alpha in np.geomspace(1, 1e-5, 40):
        w, _ = mo.solve_linear(*m, kind, alpha, 0.5, start=near)
        near = w
        l1 = alpha * (1 if kind == "lasso" else 0.5)
        rest = b - a @ w - (alpha - l1) * w
        off = np.where(w != 0, np.abs(rest - l1 * np.sign(w)), np.maximum(np.abs(rest) - l1, 0)) / spread
        assert off[:-1].max() < 1e-4 * np.sqrt(cov[-1, -1])
        assert w[-1] == 0  # a constant column has no say


def test_scale_of_a_column_makes_no_difference_without_penalty():
    x, y = design()
    x = x[:, [0, 4, 8]]
    w, c = mo.solve_linear(*moments(x, y), "lasso", 0.0)
    big, d = mo.solve_linear(*moments(x * [1, 1e6, 1e-6], y), "lasso", 0.0)
    assert np.allclose(big * [1, 1e6, 1e-6], w, rtol=1e-6) and np.isclose(c, d)


def test_constant_label_and_start():
    x, y = design()
    w, c = mo.solve_linear(*moments(x, np.full(len(y), 4.0)), "lasso", 0.1, start=np.ones(x.shape[1]))
    assert not w.any() and c == 4.0
    m = moments(x[:, 8:12], y)
    assert np.allclose(mo.solve_linear(*m, "lasso", 0.01)[0], mo.solve_linear(*m, "lasso", 0.01, start=np.full(4, 50.0))[0], atol=1e-9)
