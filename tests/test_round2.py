"""Paths that once lost rows, read stale data or changed results."""

import functools
import math
import operator
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions.ordered import global_row_number, previous_row
from plinth.functions import sizing
from plinth.functions.sizing import broadcast_if_small, hold, release_held
from plinth.operators import ensemble as ens
from plinth.operators import models as mo
from plinth.operators import quality as qa
from plinth.operators import runlog as rl
from plinth.operators import shape as sh
from plinth.plans.facts import _input_signature
from plinth.session import ensure_checkpoint_dir
from plinth.sources import files as fs
from plinth.streaming.runlog_stream import append_batch

RUNS = T.StructType([T.StructField(n, t) for n, t in (("run_id", T.LongType()), ("model", T.StringType()), ("rmse", T.DoubleType()), ("hyperparams", T.StringType()), ("feat_hash", T.StringType()))])


def test_a_batch_that_runs_twice_appends_once(spark, tmp_path):
    log = f"{tmp_path}/log"
    spark.createDataFrame([(1, "a", 0.5, "{}", "h")], RUNS).write.parquet(f"{log}/batch=-1")
    batch = spark.createDataFrame([(2, "a", 0.5, "{}", "h"), (3, "b", 0.1, "{}", "h"), (4, "b", 0.1 + 1e-9, "{}", "h"), (5, "c", None, None, None)], RUNS)
    for _ in range(2):
        append_batch(batch, 0, log, RUNS)
        got = spark.read.schema(RUNS).parquet(log)
        assert sorted(r["run_id"] for r in got.collect()) == [1, 3, 5]
    append_batch(batch, 1, log, RUNS)
    assert sorted(r["run_id"] for r in spark.read.schema(RUNS).parquet(log).collect()) == [1, 3, 5]


def test_leak_is_reported_among_many_failures(spark):
    rows = [("nulls", f"c{i}", False, "1") for i in range(60)] + [("key_overlap", "Id", False, "3")]
    checks = spark.createDataFrame(rows, "check string, column string, passed boolean, detail string").coalesce(1)
    with pytest.raises(qa.DataLeakageError):
        qa.raise_on_failure(checks)


def test_prediction_files_keep_every_data_line(spark, tmp_path):
    for name, text in {"1_a": 'Id,SalePrice\n"2",4.0\nNaN,3.0\n3,5.5\n4,\n', "2_b": "SalePrice,note,Id\n1.5,x,7\n", "notes": "row,text\n1,x\n"}.items():
        os.makedirs(tmp_path / name)
        (tmp_path / name / "f.csv").write_text(text)
    got = sorted(map(tuple, fs.read_prediction_files(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([("1_a", 2, 4.0), ("1_a", None, 3.0), ("1_a", 3, 5.5), ("1_a", 4, None), ("2_b", 7, 1.5)], key=str)
    assert fs.read_prediction_files(spark, str(tmp_path / "notes")).count() == 0


def test_surplus_predictions_are_an_error(spark):
    ids = spark.createDataFrame([(1,), (2,)], "Id long")
    preds = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "Id long, pred double")
    with pytest.raises(fs.SubmissionError, match="not asked for"):
        fs.create_submission(preds, ids)
    assert fs.create_submission(preds.where("Id < 3"), ids).count() == 2


def test_two_predictions_for_a_key_are_an_error(spark):
    long = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0)], "model string, Id long, SalePrice double")
    with pytest.raises(Exception, match="more than one prediction"):
        fs.predictions_wide(long, models=["a"]).collect()


def test_equal_rows_are_matched_one_by_one(spark):
    board = spark.createDataFrame([("Team One", 0.1, 1), ("other", 0.2, 2)], "name string, score double, rank int")
    mine = spark.createDataFrame([("team_one", 0.9), ("team_one", 0.9), ("x", 0.20005), ("y", 0.5), ("z", None)], "name string, score double")
    got = rl.match_to_leaderboard(mine, board).collect()
    assert sorted(((r["name"], r["rank"]) for r in got), key=str) == sorted([("team_one", 1), ("team_one", 1), ("x", 2), ("y", None), ("z", None)], key=str)


def test_missing_submission_column_fails_its_check(spark):
    sub = spark.createDataFrame([(1, 2.0)], "Id long, other double")
    (row,) = qa.submission_format(sub, sub.select("Id"), "Id", "price").collect()
    assert (row["check"], row["passed"], row["detail"]) == ("columns", False, "price")


def test_submission_order_is_checked(spark):
    sub = spark.createDataFrame([(1, 2.0, 0), (2, 3.0, 1)], "Id long, price double, pos long")
    want = spark.createDataFrame([(1, 1), (2, 0)], "Id long, pos long")
    got = {r["check"]: r["passed"] for r in qa.submission_format(sub, want, "Id", "price", "pos").collect()}
    assert got["id_order_match"] is False and got["id_set_match"] is True


def test_duplicate_rows_are_found_through_their_keys(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (1, "b", 1.0), (None, "n", 2.0), (None, "n", 2.0), (3, "c", None)]
    df = spark.createDataFrame(rows, "k long, v string, t double")
    got = {r["check"]: (r["passed"], r["detail"]) for r in qa.raw_integrity(df, ["k"], "t").collect()}
    assert got["no_duplicate_rows"] == (False, "2") and got["key_unique"] == (False, "3")
    assert got["target_not_null"] == (False, "1") and got["rows_nonzero"][0]
    empty = {r["check"]: r["passed"] for r in qa.raw_integrity(df.limit(0), ["k"], None).collect()}
    assert empty["rows_nonzero"] is False and empty["no_duplicate_rows"] is True


def test_fingerprint_follows_the_rows(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") * 2.0).alias("x"))
    same = ens.input_fingerprint(df.orderBy(F.desc("id")).repartition(3), "ridge")
    assert ens.input_fingerprint(df, "ridge") == same != ens.input_fingerprint(df, "lasso")
    assert ens.input_fingerprint(df.withColumn("x", F.when(F.col("id") == 3, 0.0).otherwise(F.col("x"))), "ridge") != same
    calls = []
    compute = lambda: calls.append(1) or df
    for _ in range(2):
        assert ens.cached_oof(spark, str(tmp_path), same, compute).count() == 10
    assert calls == [1]


def test_signature_sees_a_replaced_part_file(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    before = _input_signature(spark, str(tmp_path), ["t"])
    assert before == _input_signature(spark, str(tmp_path), ["t"])
    (part,) = (tmp_path / "t.parquet").glob("part-*.parquet")
    os.utime(part, (1, 1))
    assert before != _input_signature(spark, str(tmp_path), ["t"])


def test_only_own_caches_are_released(spark):
    release_held()
    mine = spark.range(5).cache()
    mine.count()
    held = hold(spark.range(7))
    held.count()
    release_held()
    assert mine.is_cached and mine.storageLevel.useMemory and not held.storageLevel.useMemory
    mine.unpersist()


def test_broadcast_counts_bytes(spark, monkeypatch):
    wide = spark.range(100).select("id", *[F.concat(F.lit("x"), F.col("id")).alias(f"c{i}") for i in range(50)])
    plan = lambda df: spark.range(10).join(df, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(broadcast_if_small(wide)).lower()
    monkeypatch.setattr(sizing, "BROADCAST_MAX_BYTES", 50 * sizing.row_bytes(wide))
    assert "strategy=broadcast" not in plan(broadcast_if_small(wide)).lower()
    assert "strategy=broadcast" not in plan(broadcast_if_small(wide, bound=90)).lower()


def test_factory_errors_are_not_retried():
    def factory(train):
        raise TypeError("inside")

    with pytest.raises(TypeError, match="inside"):
        mo._estimator(factory, None)
    assert mo._estimator(lambda: 5, None) == 5 and mo._estimator(lambda t: t, 6) == 6
    assert mo._estimator(lambda loss="squared": loss, None) == "squared" and mo._estimator(lambda t, loss=1: (t, loss), 6) == (6, 1)


def test_simplex_weights_are_optimal():
    rng = np.random.default_rng(0)
    for k in (1, 2, 3, 6, 9):
        for _ in range(20):
            p = rng.normal(size=(40, k)) + rng.normal(size=(40, 1)) * rng.choice([0, 3])
            y = p @ rng.dirichlet(np.ones(k)) + rng.normal(size=40) * rng.choice([0.0, 1.0])
            g, b = p.T @ p, p.T @ y
            w = ens.simplex_qp(g, b)
            assert abs(w.sum() - 1) < 1e-9 and w.min() >= 0
            grad = g @ w - b  # at the optimum no feasible direction falls
            assert grad.min() >= (grad @ w) - 1e-6 * max(1, np.abs(grad).max())
    twins = np.ones((2, 2))
    assert ens.simplex_qp(twins, np.ones(2)).sum() == pytest.approx(1)


@pytest.mark.parametrize("power", [-6.5, 0.3, 8.0])
def test_lambda_outside_the_first_bracket_is_found(spark, power):
    rng = np.random.default_rng(1)
    z = rng.normal(0, 0.02, 2000)
    x = np.power(1 + power * z, 1 / power)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = sh.fit_lambdas(df, ["x"], "box-cox")["x"]

    def loss(q):
        t = (x**q - 1) / q
        return -len(x) / 2 * math.log(t.var()) + (q - 1) * np.log(x).sum()

    best = max(np.linspace(-40, 40, 4001)[np.abs(np.linspace(-40, 40, 4001)) > 1e-9], key=loss)
    assert loss(lam) >= loss(best) - 1e-2


def test_ks_distance_of_all_series_in_one_pass(spark):
    rng = np.random.default_rng(2)
    series = {"n": rng.normal(3, 2, 400), "e": rng.exponential(1, 300), "one": np.array([1.0, 1.0])}
    df = spark.createDataFrame([(s, float(v)) for s, x in series.items() for v in x], "s string, v double")
    got = {r["series"]: r["value"] for r in sh.ks_normal(df, "s", "v").collect()}
    for s, x in series.items():
        z = np.sort((x - x.mean()) / max(x.std(), 1e-12))
        p = np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z])
        k = np.arange(len(x))
        assert got[s] == pytest.approx(max((p - k / len(x)).max(), ((k + 1) / len(x) - p).max()), abs=1e-6)


def test_previous_row_across_chunk_borders(spark):
    rows = [(g, i, float(i * (1 + (g == "a")))) for g in ("a", "b", None) for i in range(25)]
    df = spark.createDataFrame(rows, "g string, i int, v double").repartition(3)
    for chunk in (1, 4, 1000):
        got = {(r["g"], r["i"]): r["prev_v"] for r in previous_row(df, ["g"], ["i"], ["v"], chunk_rows=chunk).collect()}
        assert got == {(g, i): (None if i == 0 else float((i - 1) * (1 + (g == "a")))) for g, i, _ in rows}


def test_row_numbers_run_no_job_before_the_sort(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    out = global_row_number(df, ["k"])
    assert set(tracker.getJobIdsForGroup(None)) - before == set()
    assert [r["rn"] for r in out.orderBy("k").collect()] == list(range(1, 8))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    assert ensure_checkpoint_dir(spark)


def test_encoding_noise_belongs_to_the_row(spark):
    from plinth.operators.target_encode import oof_target_encode

    rows = [(i, f"c{i % 4}", float(i % 7), i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, cat string, y double, fold int")
    enc = lambda d, **kw: {r["id"]: r["cat_TargetEnc"] for r in oof_target_encode(d, df.limit(3), "cat", "y", key="id", **kw)[0].collect()}
    plain, noisy = enc(df), enc(df, noise_level=0.5)
    again = enc(df.orderBy(F.desc("id")).repartition(7), noise_level=0.5)
    assert all(abs(noisy[i] - again[i]) < 1e-12 for i in noisy) and enc(df, noise_level=0.5, seed=1) != noisy
    gap = np.array([noisy[i] - plain[i] for i in plain])
    assert 0 < gap.std() and abs(gap.mean()) < 3 * gap.std() / 20


def test_linear_grid_matches_the_fits_it_replaces(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    y = x @ np.array([1.0, -0.5, 0.0, 0.2]) + 2 + rng.normal(0, 0.3, 600)
    rows = [(*map(float, v), float(t), i % 5) for i, (v, t) in enumerate(zip(x, y))]
    feats = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double, fold int")
    grid = [{"kind": "ridge", "alpha": 5.0}, {"kind": "lasso", "alpha": 0.1}, {"kind": "elasticnet", "alpha": 0.05, "l1": 0.3}, {"kind": "ols", "alpha": 0.0}]
    for real in (False, True):
        got = {p["kind"]: (m, s) for p, m, s in mo.linear_grid(df, feats, grid, real_space=real)}
        for p in grid:
            want = mo.cv_rmse(mo.assemble(df, feats), mo.linear_factory(p["kind"], p["alpha"], p.get("l1", 0.5)), real_space=real)
            assert got[p["kind"]] == pytest.approx(want, rel=2e-3)
    # optimality of the lasso on all rows: |gradient| <= alpha, equal on its support
    whole = functools.reduce(operator.add, mo.fold_moments(df, feats).values())
    w, c = mo.solve_linear(*whole, "lasso", 0.1)
    grad = x.T @ (y - x @ w - c) / len(y)
    assert np.all(np.abs(grad) <= 0.1 + 1e-9) and np.allclose(grad[w != 0], 0.1 * np.sign(w[w != 0]))
