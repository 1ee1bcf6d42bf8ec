"""Fits that share passes: joint lambda search, the counting deal of folds, moments by blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.operators import folds as fo
from plinth.operators import models as mo
from plinth.operators import select as se
from plinth.operators import shape as sh


def log_likelihood(x, lam, kind):
    if kind == "box-cox":
        t, slope = (np.log(x) if abs(lam) < 1e-12 else (x**lam - 1) / lam), np.log(x).mean()
    else:
        pos, neg = np.maximum(x, 0), np.minimum(x, 0)
        up = np.log1p(pos) if abs(lam) < 1e-12 else ((pos + 1) ** lam - 1) / lam
        down = -np.log1p(-neg) if abs(lam - 2) < 1e-12 else -((1 - neg) ** (2 - lam) - 1) / (2 - lam)
        t, slope = np.where(x >= 0, up, down), (np.sign(x) * np.log1p(np.abs(x))).mean()
    return -np.log(t.var()) / 2 + (lam - 1) * slope


def maximum(x, kind, lo, hi):
    for _ in range(200):  # ternary search: the likelihood has one summit
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (a, hi) if log_likelihood(x, a, kind) < log_likelihood(x, b, kind) else (lo, b)
    return (lo + hi) / 2


class Jobs:
    """Actions (``collect``) on frames while open."""

    def __init__(self, monkeypatch):
        from pyspark.sql.classic.dataframe import DataFrame

        self.n, real = 0, DataFrame.collect

        def collect(frame):
            self.n += 1
            return real(frame)

        monkeypatch.setattr(DataFrame, "collect", collect)


@pytest.mark.parametrize("kind", ["yeo-johnson", "box-cox"])
def test_lambdas_of_all_columns_lie_at_their_maxima(spark, monkeypatch, kind):
    rng = np.random.default_rng(3)
    cols = {"a": rng.gamma(2.0, 3.0, 400), "b": np.exp(rng.normal(0, 1, 400)), "c": 2000 + rng.normal(0, 5, 400)}
    if kind == "yeo-johnson":
        cols["d"] = rng.normal(-1, 1, 400) ** 3
    rows = [tuple(float(v[i]) for v in cols.values()) for i in range(400)]
    gaps = [tuple(None for _ in cols), tuple(math.nan for _ in cols)]
    df = spark.createDataFrame(rows + gaps, ", ".join(f"{c} double" for c in cols)).withColumn("none", F.lit(None).cast("double")).withColumn("same", F.lit(3.0))
    got = sh.fit_lambdas(df, [*cols, "none", "same"], kind)
    assert got["none"] is None and got["same"] is None
    for c in cols:
        wide = 40 if c == "c" else 8
        best = maximum(cols[c], kind, -wide, wide)
        assert abs(got[c] - best) < (5e-3 if c == "c" else 1e-4), c
    jobs = Jobs(monkeypatch)
    sh.fit_lambdas(df, ["a"], kind)
    one, jobs.n = jobs.n, 0
    sh.fit_lambdas(df, ["a", "b"], kind)
    assert jobs.n == one == 3


def brute_folds(rows, k, n_bins, seed):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] is not None and math.isnan(r[1]), 0 if r[1] is None or math.isnan(r[1]) else r[1], r[0]))
    size, bins = max(1, len(rows) // n_bins), {}
    for i, (key, _) in enumerate(rows):
        bins.setdefault(min(i // size, n_bins - 1), []).append(key)
    out = {}
    for b, keys in bins.items():
        order = sorted(keys, key=lambda x: ((x % fo.M31 * fo.LCG_A + fo.LCG_C + seed) % fo.M31, x))
        out.update({key: (b, i % k) for i, key in enumerate(order)})
    return out


@pytest.mark.parametrize("deal_rows", [fo.DEAL_ROWS, 7])
@pytest.mark.parametrize("case", ["ties", "nulls", "few", "plain", "empty"])
def test_counting_deal_equals_two_sorts(spark, monkeypatch, case, deal_rows):
    monkeypatch.setattr(fo, "DEAL_ROWS", deal_rows)
    rng = np.random.default_rng(7)
    y = {"ties": [float(x) for x in rng.choice([1.0, 1.0, 2.5, 7.0], 211)],
         "nulls": [None] * 60 + [math.nan] * 50 + [float(x) for x in rng.normal(size=100)],
         "few": [3.0, 1.0, 2.0], "plain": [float(x) for x in rng.normal(size=157)], "empty": []}[case]
    rows = [(int(key), t) for key, t in zip(rng.permutation(5000), y)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "key long, y double, other string")
    got = fo.stratified_kfold(df, "key", "y", 4, 10, 42, keep_bin=True)
    assert got.columns == ["key", "y", "other", "_bin", "fold"]
    assert {r["key"]: (r["_bin"], r["fold"]) for r in got.collect()} == brute_folds(rows, 4, 10, 42)
    three = fo.repeated_stratified(df, "key", "y", 4, 3, 10, 42).collect()
    assert len(three) == 3 * len(rows)
    for s in range(3):
        want = brute_folds(rows, 4, 10, 42 + s)
        assert {r["key"]: r["fold"] for r in three if r["repeat"] == s} == {key: f for key, (_, f) in want.items()}


def test_moments_by_blocks_keep_their_digits(spark):
    rng = np.random.default_rng(5)
    p = 70  # more than one piece a row
    x = rng.normal(size=(500, p))
    x[:, 0] = 1e8 + rng.normal(0, 1e-2, 500)  # a large mean and a small spread
    y = x[:, 1] - 2 * x[:, 2] + 100 * (x[:, 0] - 1e8) + rng.normal(0, 0.1, 500)
    names = [f"f{i}" for i in range(p)]
    df = spark.createDataFrame([(*map(float, v), float(t), i % 3) for i, (v, t) in enumerate(zip(x, y))], ", ".join(f"{n} double" for n in names) + ", label double, fold int")
    moments = mo.fold_moments(df.repartition(3), names)
    assert sorted(moments) == [0, 1, 2] and [m.n for m in moments.values()] == [167, 167, 166]
    whole = moments[0] + moments[1] + moments[2]
    w, c = mo.solve_linear(*whole, "ols", 0.0)
    centred = x - x.mean(axis=0)
    want = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    assert np.allclose(w, want, rtol=1e-4, atol=1e-5)
    assert np.abs(x @ w + c - y).mean() < 0.2
    rest = whole - moments[1]
    assert rest.n == 333 and np.allclose(rest.s + rest.n * rest.shift, np.c_[x, y][np.arange(500) % 3 != 1].sum(axis=0))


def test_lasso_importance_takes_the_alpha_with_the_least_error(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3))
    y = 2 * x[:, 0] + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(*map(float, v), float(t), i % 5) for i, (v, t) in enumerate(zip(x, y))], "a double, b double, c double, y double, fold int")
    got = {r["feature"]: r["score"] for r in se.lasso_importance(df, "y", ["a", "b", "c"], alphas=(1e-3, 1e-2, 5.0)).collect()}
    assert abs(got["a"] - 2) < 0.05 and got["b"] < 0.05 and got["c"] < 0.05
    free = {r["feature"]: r["score"] for r in se.lasso_importance(df, "y", ["a", "b", "c"]).collect()}
    assert abs(free["a"] - 2) < 0.05 and free["b"] < 0.05
