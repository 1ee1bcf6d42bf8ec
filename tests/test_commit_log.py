import hashlib
import json

import pytest
from pyspark.sql import functions as F

from plinth.sources import files
from plinth.sources.commit_log import CommitLog

SCHEMA = "file string, score double"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def got(log):
    return sorted((r["file"], r["score"]) for r in log.read().collect())


def test_array_file_and_appended_entries_read_back_alike(spark, tmp_path):
    path = tmp_path / "submissions.json"
    text = json.dumps([{"file": "a", "score": 1.0}, {"file": "b", "score": None}], indent=2)
    path.write_text(text)
    files.append_json_log(spark, str(path), SCHEMA, rows(spark, ("c", 3.0), ("d", 4.0)).repartition(2), txn="x")
    new = spark.createDataFrame([("e", 5.0, "hash")], SCHEMA + ", file_hash string")
    out = files.append_json_log(spark, str(path), SCHEMA, new)
    want = [("a", 1.0, None), ("b", None, None), ("c", 3.0, None), ("d", 4.0, None), ("e", 5.0, "hash")]
    assert sorted(map(tuple, out.select("file", "score", "file_hash").collect())) == want
    # the log may be its own input: what was read before an append is still there after it
    log = files.json_log(spark, str(path), SCHEMA)
    log.append(log.read().where("file = 'a'"))
    assert log.read().count() == 6 and path.read_text() == text


def test_a_crash_before_the_commit_and_a_rerun_lose_and_double_nothing(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"), key="file")
    assert log.commits() == [] and not log.read().collect()
    log.append(rows(spark, ("a", 1.0)))

    def died(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_commit", died)
        with pytest.raises(OSError):
            log.append(rows(spark, ("b", 2.0)), txn="second")
    assert got(log) == [("a", 1.0)]
    (tmp_path / "log" / "commits" / f"{2:020d}").write_text('{"folder": "data/')  # a commit that was cut off
    assert log.append(rows(spark, ("b", 2.0)), txn="second") == 3
    assert log.append(rows(spark, ("b", 2.0)), txn="second") == 3
    assert got(log) == [("a", 1.0), ("b", 2.0)]


def test_a_point_update_rewrites_one_bucket(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), key="file", buckets=4)
    log.append(rows(spark, *[(f"f{i}", float(i)) for i in range(40)], (None, 0.0)))
    log.append(rows(spark, ("f3", 33.0)))
    change = lambda df: df.withColumn("score", F.when(F.col("file") == "f3", 0.5).otherwise(F.col("score")))
    log.update("f3", change, txn="u")
    assert log.update("f3", change, txn="u") == 3
    log.append(rows(spark, ("f3", 7.0)))
    want = {f"f{i}": [float(i)] for i in range(40)} | {"f3": [0.5, 0.5, 7.0], None: [0.0]}
    have = {}
    for r in log.read().orderBy("score").collect():
        have.setdefault(r["file"], []).append(r["score"])
    assert have == want
    folder = tmp_path / "log" / log.commits()[2]["folder"]
    assert len([p for p in folder.iterdir() if p.name.startswith("_bucket=")]) == 1
    plan = log.read()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [NOT" in plan or "PartitionFilters: [isnotnull(_bucket" in plan


def test_two_writers_take_two_numbers_and_a_lost_update_is_an_error(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), key="file", buckets=1)
    log.append(rows(spark, ("a", 1.0)))

    def meanwhile(df):
        CommitLog(spark, log.path, key="file", buckets=1).append(rows(spark, ("b", 2.0)))
        return df

    with pytest.raises(RuntimeError, match="meanwhile"):
        log.update("a", meanwhile)
    entry = log._write(rows(spark, ("c", 3.0))) | {"replaces": None, "txn": None}
    assert log._commit(1, entry, lambda _: False) == 3  # number 2 is taken
    assert got(log) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_manifest_takes_the_newest_commit(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), key="file")
    log.append(rows(spark, ("s1", 1.0), ("s2", 1.0)))
    log.append(rows(spark, ("s1", 2.0)))
    assert sorted(map(tuple, log.latest("file").collect())) == [("s1", 2.0), ("s2", 1.0)]


def test_file_digests_equal_md5_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "CHUNK_BYTES", 7)
    content = {"a b%20c.csv": b"1", "x.csv": b"0123456", "y.csv": bytes(range(256)) * 1000, "sub/z.csv": b"z" * 15}
    for name, data in content.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    (tmp_path / "other.txt").write_text("no")
    have = {r["name"]: (r["length"], r["hash"]) for r in files.fingerprint_files(spark, str(tmp_path), "*.csv").collect()}
    assert have == {n.split("/")[-1]: (len(d), hashlib.md5(d).hexdigest()) for n, d in content.items()}
    log = spark.createDataFrame([("x.csv", 1, "old"), ("x.csv", 2, have["x.csv"][1]), ("y.csv", 1, have["y.csv"][1]), ("y.csv", 2, "new"), ("z.csv", 1, None)],
                                "name string, timestamp int, hash string")
    out = {r["name"]: r["submitted"] for r in files.already_submitted(files.fingerprint_files(spark, str(tmp_path), "*.csv"), log).collect()}
    assert out == {"a b%20c.csv": False, "x.csv": True, "y.csv": False, "z.csv": True}
