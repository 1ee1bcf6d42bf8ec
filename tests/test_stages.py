"""The resumable stage graph and the gates of the composed jobs."""

import pytest
from pyspark.sql import functions as F

from plinth.operators.quality import DataIntegrityError, DataLeakageError
from plinth.plans import pipeline as pl


def pair(spark, shift=0):
    tr = spark.createDataFrame([(i, float(i % 7) + shift, float((i * 37) % 11)) for i in range(60)], "okey long, y double, a double")
    ts = spark.createDataFrame([(i, float(i % 5)) for i in range(100, 130)], "okey long, a double")
    return tr, ts


def steps(log, fail=None, factor=2.0):
    def step(n):
        def work(tr, ts):
            log.append(n)
            if n == fail:
                raise RuntimeError("killed")
            return tr.withColumn("a", F.col("a") * factor), ts.withColumn("a", F.col("a") * factor)
        return work
    return [(n, {"factor": factor}, step(n)) for n in (1, 2, 3)]


def test_a_killed_run_starts_at_the_first_missing_stage(spark, tmp_path):
    start, log = pair(spark), []
    with pytest.raises(RuntimeError, match="killed"):
        pl.Stages(spark, str(tmp_path), "in").run(steps(log, fail=3), start)
    assert log == [1, 2, 3]
    log.clear()
    again = pl.Stages(spark, str(tmp_path), "in")
    tr, ts, gates = again.run(steps(log), start)
    assert log == [3] and again.ran == [3] and len(gates) == 3
    assert tr.agg(F.sum("a")).first()[0] == 8 * start[0].agg(F.sum("a")).first()[0] and ts.count() == 30
    assert all(g.where("check = 'stage_gate' AND passed").count() == 1 for g in gates)
    log.clear()
    pl.Stages(spark, str(tmp_path), "in").run(steps(log), start)
    assert log == []
    for other in (dict(mark="else", factor=2.0), dict(mark="in", factor=3.0)):  # another input or setting
        log.clear()
        pl.Stages(spark, str(tmp_path), other["mark"]).run(steps(log, factor=other["factor"]), start)
        assert log == [1, 2, 3]
    assert again.manifest.read().count() == 9


@pytest.mark.parametrize("broken,error", [
    (lambda tr, ts: (tr.withColumn("a", F.when(F.col("okey") > 3, F.col("a"))), ts), DataIntegrityError),
    (lambda tr, ts: (tr, ts.withColumn("okey", F.col("okey") - 100)), DataLeakageError),
    (lambda tr, ts: (tr.withColumn("b", F.col("y") * 2), ts.withColumn("b", F.col("a"))), DataLeakageError),
    (lambda tr, ts: (tr.withColumn("only", F.lit(1.0)), ts), DataIntegrityError),
    (lambda tr, ts: (tr.withColumn("y", F.when(F.col("okey") > 3, F.col("y"))), ts), DataIntegrityError),
    (lambda tr, ts: (tr, ts.withColumn("y", F.col("a"))), DataIntegrityError),
    (lambda tr, ts: (tr, ts.where("okey > 105")), DataIntegrityError),
    (lambda tr, ts: (tr.withColumn("a", F.lit(float("inf"))), ts), DataIntegrityError),
])
def test_a_stage_that_fails_its_gate_is_not_committed(spark, tmp_path, broken, error):
    before = pair(spark)
    with pytest.raises(error):
        pl.gate(*broken(*before), 4, before)
    run = pl.Stages(spark, str(tmp_path), "in")
    with pytest.raises(error):
        run.run([(1, {}, lambda tr, ts: (tr, ts)), (4, {}, broken)], before)
    assert run.ran == [1] and [c["txn"] is not None for c in run.manifest.commits()] == [True]


def test_train_job_logs_its_runs_and_refuses_bad_predictions(spark, tmp_path):
    tr, ts = pair(spark, shift=5)
    sub, log, checks = pl.train_and_submit(spark, tr, ts, ["a"], str(tmp_path))
    assert sub.count() == 30 and checks.where("NOT passed").count() == 0
    assert (tmp_path / "submission_ridge").exists()
    _, log, _ = pl.train_and_submit(spark, tr, ts, ["a"], str(tmp_path), "lasso", 0.01)
    assert [r["model"] for r in log.orderBy("timestamp").collect()] == ["ridge", "lasso"]
    constant = tr.withColumn("y", F.lit(12.0))
    with pytest.raises(DataIntegrityError):  # predictions that do not vary
        pl.train_and_submit(spark, constant, ts, ["a"], str(tmp_path), "lasso", 10.0, name="flat")
    assert not (tmp_path / "submission_flat").exists()
