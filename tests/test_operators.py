import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.operators import ensemble as ens
from plinth.operators import folds as fo
from plinth.operators import models as mo
from plinth.operators import quality as qa
from plinth.operators import runlog as rl
from plinth.operators import shape as sh


def test_model_name_normalisation(spark):
    names = ["catboost_model.csv", "CatBoost_Model.csv", "my_xgboost_model_v2.csv",
             "blend_xgb_lgb_cat_model_and_naive_lr.csv", "7_xgboost", "unknown.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r[0] for r in df.select(rl.normalize_model_name(F.col("f"))).collect()]
    assert got == ["catboost", "catboost", "xgboost", "blending", "7_xgboost", "unknown"]
    got2 = [r[0] for r in df.select(rl.strip_numeric_prefix(F.col("f"))).collect()]
    assert got2[4] == "xgboost"


def test_runtime_format_quirk(spark):
    df = spark.createDataFrame([(30.7,), (75.0,), (3600.0,), (3725.0,), (None,)], "s double")
    got = [r[0] for r in df.select(rl.format_runtime(F.col("s"))).collect()]
    assert got == ["30s", "1m 15s", "1h 0s", "1h 2m 5s", ""]


def test_feature_hash_matches_python(spark):
    import hashlib
    import json
    feats = ["b", "a", "c d"]
    df = spark.createDataFrame([(feats,)], "f array<string>")
    got = df.select(rl.feature_hash(F.col("f"))).first()[0]
    assert got == hashlib.md5(json.dumps(sorted(feats)).encode()).hexdigest()[:8]


def test_kfold_and_validity(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    f = fo.kfold(df, "key", 5, 42)
    res = {r["check"]: r["passed"] for r in qa.fold_validity(f, "key", "fold", 5).collect()}
    assert all(res.values())
    dup = f.unionByName(fo.kfold(df, "key", 5, 7))
    res = {r["check"]: r["passed"] for r in qa.fold_validity(dup, "key", "fold", 5).collect()}
    assert not res["validated_exactly_once"]


def test_stratified_folds_are_balanced(spark):
    df = spark.range(1003).select(F.col("id").alias("key"), F.rand(1).alias("y"))
    f = fo.stratified_kfold(df, "key", "y", 5, 10, 42, keep_bin=True)
    counts = f.groupBy("_bin", "fold").count().toPandas()
    # every bin spreads its rows over all folds, sizes differ by at most one
    for _, g in counts.groupby("_bin"):
        assert len(g) == 5 and g["count"].max() - g["count"].min() <= 1


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(scale=0.3, size=400)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)],
                               "a double, b double, c double, label double")
    alpha = 25.0
    w, b0 = mo.ridge_closed_form(df, ["a", "b", "c"], "label", alpha)
    data = mo.assemble(df, ["a", "b", "c"])
    n, s = mo.label_stats(data)
    m = mo.fit_linear("ridge", alpha, n=n, y_std=s).fit(data)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-6)
    assert m.intercept == pytest.approx(b0, abs=1e-6)


def test_blend_weights_on_simplex(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(size=500)
    p1, p2, p3 = y + rng.normal(scale=0.2, size=500), y + rng.normal(scale=0.5, size=500), rng.normal(size=500)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for a, b, c, t in zip(p1, p2, p3, y)],
                               "m1 double, m2 double, m3 double, y double")
    w = ens.optimize_weights(df, ["m1", "m2", "m3"], "y")
    assert sum(w.values()) == pytest.approx(1.0) and min(w.values()) >= 0
    best = ens.blend_rmse(df, ["m1", "m2", "m3"], "y", w)
    for a in np.linspace(0, 1, 21):
        assert best <= ens.blend_rmse(df, ["m1", "m2", "m3"], "y", {"m1": a, "m2": 1 - a, "m3": 0.0}) + 1e-9


def test_yeo_johnson_lambda_near_mle(spark):
    rng = np.random.default_rng(2)
    x = rng.exponential(3.0, 2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = sh.fit_power(df, ["x"])["x"]["lambda"]

    def ll(lmb):
        t = np.log1p(x) if abs(lmb) < 1e-12 else ((x + 1) ** lmb - 1) / lmb
        return -len(x) / 2 * np.log(t.var()) + (lmb - 1) * np.log1p(x).sum()

    grid = np.linspace(-2, 2, 4001)
    best = grid[np.argmax([ll(g) for g in grid])]
    assert abs(lam - best) < 2e-3


def test_norm_ppf(spark):
    df = spark.createDataFrame([(0.001,), (0.025,), (0.5,), (0.975,), (0.999,)], "p double")
    got = [r[0] for r in df.select(sh.norm_ppf(F.col("p"))).collect()]
    exp = [-3.090232306, -1.959963985, 0.0, 1.959963985, 3.090232306]
    assert got == pytest.approx(exp, abs=1e-7)


def test_kmeans_labels(spark):
    from plinth.operators import cluster as cl
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(c, 0.1, size=(50, 2)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, a double, b double")
    tr, _ = cl.kmeans_feature(df, df.limit(0), ["a", "b"], k=3, restarts=2)
    labels = tr.groupBy("Cluster").count().collect()
    assert len(labels) == 3 and all(r["count"] == 50 for r in labels)


def test_evaluate_many_moments(spark):
    rng = np.random.default_rng(42)
    a, b = rng.normal(size=500), rng.exponential(size=500)
    rows = [("normal", float(v)) for v in a] + [("expo", float(v)) for v in b]
    df = spark.createDataFrame(rows, "s string, v double")
    out = {(r["series"], r["metric"]): r for r in sh.evaluate_many(df, "s", "v").collect()}

    def corrected(x):
        n = len(x)
        m = x.mean()
        m2, m3, m4 = ((x - m) ** 2).mean(), ((x - m) ** 3).mean(), ((x - m) ** 4).mean()
        g1, g2 = m3 / m2 ** 1.5, m4 / m2 ** 2 - 3
        return abs(g1 * math.sqrt(n * (n - 1)) / (n - 2)), abs(((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))

    sk, ku = corrected(b)
    assert out[("expo", "abs_skew")]["value"] == pytest.approx(round(sk, 3))
    assert out[("expo", "abs_excess_kurt")]["value"] == pytest.approx(round(ku, 3))
    assert out[("expo", "abs_skew")]["overall_pass"] is False
