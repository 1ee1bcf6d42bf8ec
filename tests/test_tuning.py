"""Successive halving against a plain reading of its rules, and its time budget."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from plinth.operators import models as mo
from plinth.operators import tuning

SPACE = {"alpha": (0.001, 10.0, "log"), "shape": ["a", "b"]}


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(200).select((F.col("id") % 5).alias("fold"), F.col("id").cast("double").alias("x"), F.rand(3).alias("label"))
    return mo.assemble(rows, ["x"]).select("features", "label", "fold")


def score_of(params, k) -> float:
    return abs(params["alpha"] - 1.0) * (1 + k) + (params["shape"] == "b") * 0.01


def plain_halving(params, folds, eta):
    """(state, folds scored) of each trial, cohort by cohort, one after the other."""
    rungs = tuning.rung_folds(folds, eta)
    out, size = {}, eta ** (len(rungs) - 1)
    for at in range(0, len(params), size):
        left, used = list(range(at, min(at + size, len(params)))), []
        for i, some in enumerate(rungs):
            used += some
            for t in left:
                out[t] = ("complete" if i == len(rungs) - 1 else "cut", len(used))
            if i < len(rungs) - 1:
                mean = {t: sum(score_of(params[t], k) for k in used) / len(used) for t in left}
                left = sorted(left, key=lambda t: (mean[t], t))[: max(1, len(left) // eta)]
    return out


@pytest.fixture
def quick(monkeypatch):
    """Fits that end in an order of their own, each after a short while; the count of fits."""
    fits, lock = [], threading.Lock()

    def fit(data, factory, k, fold="fold", **kw):
        params = factory()
        with lock:
            fits.append((params["alpha"], k))
        time.sleep((hash((params["alpha"], k)) % 7) / 1000)
        return score_of(params, k)

    monkeypatch.setattr(tuning, "cv_fold_rmse", fit)
    return fits


def test_rung_folds_hold_every_fold_once():
    assert tuning.rung_folds([0, 1, 2, 3, 4], 3) == [[0], [1, 2], [3, 4]]
    assert tuning.rung_folds([7], 3) == [[7]]
    assert tuning.rung_folds([], 3) == []


@pytest.mark.parametrize("trials, threads, eta", [(50, 1, 3), (50, 8, 3), (20, 4, 2), (1, 4, 3)])
def test_halving_matches_its_rules_on_any_number_of_workers(table, quick, trials, threads, eta):
    found = tuning.rung_search(table, SPACE, lambda p: (lambda: p), trials, seed=1, threads=threads, eta=eta)
    params = mo.sample_space(SPACE, trials, 1)
    expected = plain_halving(params, [0, 1, 2, 3, 4], eta)
    assert {t.number: (t.state, len(t.scores)) for t in found} == expected
    assert len(quick) == len(set(quick)) == sum(n for _, n in expected.values())  # no fit twice, none left out
    whole = [t for t in found if t.state == "complete"]
    assert found[: len(whole)] == whole and [t.rmse for t in whole] == sorted(t.rmse for t in whole)


def test_equal_scores_and_scores_that_are_not_finite(table, monkeypatch):
    monkeypatch.setattr(tuning, "cv_fold_rmse", lambda data, factory, k, fold="fold", **kw: float("nan") if factory()["shape"] == "b" else 1.0)
    found = tuning.rung_search(table, SPACE, lambda p: (lambda: p), 9, seed=1, threads=4)
    best = min(t.number for t in found if t.params["shape"] == "a")
    assert [t.number for t in found if t.state == "complete"] == [best]


def test_no_rows_and_no_folds(spark, table):
    found = tuning.rung_search(table.limit(0), SPACE, lambda p: (lambda: p), 3)
    assert [(t.state, t.rmse, t.std) for t in found] == [("stopped", None, None)] * 3
    assert tuning.trials_table(spark, found).count() == 3


def test_an_error_in_a_fit_is_raised(table, monkeypatch):
    def fit(*_args, **_kw):
        raise ValueError("no such parameter")

    monkeypatch.setattr(tuning, "cv_fold_rmse", fit)
    with pytest.raises(ValueError, match="no such parameter"):
        tuning.rung_search(table, SPACE, lambda p: (lambda: p), 5)


def test_running_fits_end_with_the_budget(spark, table, monkeypatch):
    """Jobs that would take minutes are cancelled; trials scored before keep their scores, other jobs go on."""
    ended = []

    def fit(data, factory, k, fold="fold", **kw):
        if factory()["alpha"] < 0.1:
            return 1.0
        try:
            return float(spark.sparkContext.parallelize(range(2), 2).map(lambda _: __import__("time").sleep(120) or 1).sum())
        finally:
            ended.append(k)

    monkeypatch.setattr(tuning, "cv_fold_rmse", fit)
    start = time.monotonic()
    found = tuning.rung_search(table, SPACE, lambda p: (lambda: p), 12, seed=1, threads=3, time_budget_s=5)
    assert time.monotonic() - start < 40
    assert ended and all(t.state == "stopped" for t in found if t.params["alpha"] >= 0.1)
    assert spark.range(10).count() == 10  # the session is as before


def test_search_finds_the_better_model(spark):
    rows = spark.range(400).select((F.col("id") % 3).alias("fold"), (F.col("id") % 20).cast("double").alias("x"))
    data = mo.assemble(rows.withColumn("label", F.col("x") * 2), ["x"]).select("features", "label", "fold")
    found = tuning.rung_search(data, {"alpha": [0.0, 50.0]}, lambda p: mo.linear_factory("lasso", p["alpha"]), 2, threads=2, eta=2)
    assert found[0].params == {"alpha": 0.0} and found[0].state == "complete" and found[0].rmse < 0.01
    assert found[1].state == "cut" and len(found[1].scores) == 1


def test_fits_read_few_even_partitions(spark, monkeypatch):
    rows = spark.range(4000).select((F.col("id") % 5).alias("fold"), F.col("id").cast("double").alias("x"), F.rand(3).alias("label"))
    uneven = mo.assemble(rows, ["x"]).select("features", "label", "fold").repartition(60, "fold")
    seen = []

    def fit(data, factory, k, fold="fold", **kw):
        sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((data.rdd.getNumPartitions(), sum(sizes), max(sizes)))
        return 0.0

    monkeypatch.setattr(tuning, "cv_fold_rmse", fit)
    tuning.rung_search(uneven, SPACE, lambda p: (lambda: p), trials=1, seed=1, threads=1)
    most = spark.sparkContext.defaultParallelism
    assert seen and all(parts <= most and n == 4000 and largest <= 2 * 4000 / parts for parts, n, largest in seen)
