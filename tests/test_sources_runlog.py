import pytest
from pyspark.sql import functions as F

from plinth.operators import ensemble as ens
from plinth.operators import runlog as rl
from plinth.session import scratch_path
from plinth.sources import files as fs


def test_leaderboard_rank_and_match(spark):
    board = spark.createDataFrame([("alpha", 0.120), ("beta", 0.125), ("gamma", 0.125), ("delta", 0.130),
                                   ("eps", 0.140)], "name string, score double")
    ranked = rl.rank_and_quantile(board, "score")
    got = {r["name"]: (r["rank"], round(r["quantile"], 6)) for r in ranked.collect()}
    assert got["alpha"] == (1, 100.0) and got["beta"] == (2, 80.0) and got["gamma"] == (2, 80.0)
    assert got["eps"] == (5, 20.0)
    mine = spark.createDataFrame([("Beta ", 0.5), ("nobody", 0.13004), ("far", 0.2)], "name string, score double")
    m = {r["name"]: r["rank"] for r in rl.match_to_leaderboard(mine, ranked, "name", "score", 1e-4).collect()}
    assert m == {"Beta ": 2, "nobody": 4, "far": None}


def test_create_submission_validation(spark):
    ids = spark.range(5).withColumnRenamed("id", "key")
    good = ids.select("key", F.lit(12.0).alias("pred"))
    sub = fs.create_submission(good, ids, key="key")
    assert sub.count() == 5 and sub.where("SalePrice <= 0").count() == 0
    with pytest.raises(fs.SubmissionError):
        fs.create_submission(good.where("key < 3"), ids, key="key")
    with pytest.raises(fs.SubmissionError):
        fs.create_submission(ids.select("key", F.lit(-1.0).alias("pred")), ids, key="key", log_space=False)


def test_stage_errors(spark):
    base = scratch_path(spark, "stage-test")
    with pytest.raises(fs.StageError):
        fs.stage_path(base, 9)
    with pytest.raises(FileNotFoundError):
        fs.load_stage(spark, base, 3)
    fs.save_stage(spark.range(0), base, 2)
    with pytest.raises(fs.StageError):
        fs.load_stage(spark, base, 2)


def test_align_predictions_mismatch(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, pred double")
    b = spark.createDataFrame([(1, 1.5)], "k long, pred double")
    with pytest.raises(ens.AlignmentError):
        ens.align_predictions({"a": a, "b": b}, "k")
    assert ens.align_predictions({"a": a, "b": b}, "k", strict=False).count() == 2


def test_append_runs_sequential_semantics(spark):
    log = spark.createDataFrame([(1, "m", 0.1, "{}", "h1")], "run_id long, model string, rmse double, hyperparams string, feat_hash string")
    new = spark.createDataFrame([(2, "m", 0.1, "{}", "h1"), (3, "m", 0.2, "{}", "h1"), (4, "m", 0.2, "{}", "h1")],
                                log.schema)
    out = rl.append_runs(log, new)
    assert sorted(r["run_id"] for r in out.collect()) == [1, 3]


def test_nearest_scores_with_alias(spark):
    runs = spark.createDataFrame([(1, "stacking", "2024-01-01 00:00:00"), (2, "stacking", "2024-01-03 00:00:00"),
                                  (3, "ridge", "2024-01-02 00:00:00")], "run_id long, model string, timestamp string") \
        .withColumn("timestamp", F.to_timestamp("timestamp"))
    subs = spark.createDataFrame([(10, "STACKING_META", "2024-01-02 20:00:00", 0.12), (11, "ridge", "2024-01-01 00:00:00", 0.2)],
                                 "sub_id long, model string, timestamp string, score double") \
        .withColumn("timestamp", F.to_timestamp("timestamp"))
    out = {r["run_id"]: (r["kaggle_score"], r["matched_sub"]) for r in rl.attach_nearest_scores(runs, subs).collect()}
    assert out == {1: (None, None), 2: (0.12, 10), 3: (0.2, 11)}


def test_pending_split_history_and_manifest(spark):
    cands = spark.createDataFrame([(1,), (2,), (3,)], "f long")
    done = spark.createDataFrame([(2,)], "f long")
    sub, pend = rl.pending_split(cands, done, "f")
    assert [r[0] for r in sub.collect()] == [2] and sorted(r[0] for r in pend.collect()) == [1, 3]
    log = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-03"), (3, "2024-01-02")], "run_id long, timestamp string")
    assert [r[0] for r in rl.history_newest_first(log).collect()] == [2, 3, 1]
    empty = fs.manifest_reset(spark, "stage string, version int, n long")
    upd = spark.createDataFrame([("s1", 1, 5), ("s1", 2, 7), ("s2", 1, 3)], empty.schema)
    got = {r["stage"]: (r["version"], r["n"]) for r in fs.manifest_upsert(empty, upd).collect()}
    assert got == {"s1": (2, 7), "s2": (1, 3)}


def test_quota_stream_counts_late_days_of_later_files(spark, tmp_path):
    from plinth.streaming.quota_stream import stream_daily_quota

    files = [["2024-01-20"] * 2, ["2024-01-20", "2024-01-27"], ["2024-01-01"] * 3 + ["2024-01-20"], ["2024-01-27", "2024-01-01", None]]
    for i, days in enumerate(files):
        rows = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_timestamp("d").alias("timestamp"))
        rows.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    schema = spark.read.parquet(f"{tmp_path}/in/0").schema
    run = lambda: stream_daily_quota(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt", schema, quota=4, max_files_per_trigger=1)
    want = [("2024-01-01", 4, 0, True), ("2024-01-20", 4, 0, True), ("2024-01-27", 2, 2, False)]
    assert sorted(map(tuple, run().collect())) == want
    # a later run counts the new file only
    spark.read.parquet(f"{tmp_path}/in/1").write.parquet(f"{tmp_path}/in/4")
    assert sorted(map(tuple, run().collect())) == [want[0], ("2024-01-20", 5, 0, True), ("2024-01-27", 3, 1, False)]
