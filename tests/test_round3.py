"""Steps that many queries share: one pass, one cache, one shuffle."""

import contextlib
import io

import numpy as np
from pyspark.sql import functions as F

from plinth.functions.sizing import release_held
from plinth.operators import cluster as cl, ensemble as ens, models as mo, quality as qa, shape as sh


def test_block_sums_are_those_of_nearest_centres_also_on_ties():
    rng = np.random.default_rng(0)
    for x in (rng.integers(0, 4, (3000, 3)).astype(float), rng.normal(size=(3000, 3))):
        runs = [cl.Run(np.array([0, 2]), k, 1, np.unique(rng.integers(0, 4, (k, 2)).astype(float), axis=0)) for k in (3, 5, 9)]
        total, cost = cl._add(x, runs)
        at = 0
        for run, spent in zip(runs, cost):
            own, best, d = cl._nearest(x, run)
            for c in range(len(run.centres)):
                assert total[at][-1] == (best == c).sum()
                np.testing.assert_allclose(total[at][:-1], own[best == c].sum(0))
                at += 1
            np.testing.assert_allclose(spent, d.sum())


def test_spreads_merge_without_losing_digits():
    x = np.random.default_rng(1).normal(1e6, 1e-2, 20_000)
    lams = np.array([-1.0, 0.0, 1.0, 2.0])
    merged = sum((sh._spread(part, lams, "yeo-johnson") for part in np.array_split(x[1:], 7)), sh._spread(x[:1], lams, "yeo-johnson"))
    np.testing.assert_allclose(merged.m2[2] / merged.n, (x - x.mean()).var(), rtol=1e-6)
    assert sh._spread(np.array([np.nan]), lams, "yeo-johnson") is None
    assert sh._spread(np.array([-1.0, 0.0]), lams, "box-cox") is None


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(200, 40))
    m[:, 3] = 7.0
    rows = [[None if j == 5 and i % 3 else float(v) for j, v in enumerate(r)] for i, r in enumerate(m)]
    names = [f"c{j}" for j in range(40)]
    df = spark.createDataFrame(rows, names)
    got = qa.correlations(df, "c0", names)
    assert got[3] is None
    some = np.arange(0, 200, 3)
    np.testing.assert_allclose(got[5], np.corrcoef(m[some, 0], m[some, 5])[0, 1])
    np.testing.assert_allclose(got[9], np.corrcoef(m[:, 0], m[:, 9])[0, 1])
    assert qa.correlations(df.where("false"), "c0", ["c1"]) == [None]


def test_out_of_fold_predictions_read_a_cache_and_shuffle_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 5, float(a), float(b), float(2 * a - b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, label double").repartition(3, "b")
    data = mo.assemble(df, ["a", "b"])
    bases = {"ols": mo.linear_factory("ols"), "ridge": mo.linear_factory("ridge", 1.0)}
    oof, test = ens.oof_predictions(data, bases, "id", "fold", data)
    for out in (oof, test):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            out.explain("simple")
        text = plan.getvalue().split("InMemoryRelation")[0] if out is oof else plan.getvalue()
        assert text.count("Exchange hashpartitioning(id") == 1 and "pivotfirst" not in plan.getvalue()
        if out is oof:
            assert "InMemoryTableScan" in plan.getvalue()
    joined = oof.join(df, "id")
    assert joined.count() == 200 and test.count() == 200
    assert joined.where(F.abs(F.col("pred_ols") - F.col("label")) > 1e-6).count() == 0
    release_held()
