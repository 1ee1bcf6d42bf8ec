import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plinth.functions.ordered import asof_nearest, global_row_number, previous_row, running_extreme


def _log(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    models = rng.choice(["a", "a", "a", "b", "c"], n)  # "a" is hot
    ts = pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 10_000, n), unit="s")
    val = rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "model": models, "ts": ts, "v": val})
    return spark.createDataFrame(pdf), pdf


def test_global_row_number(spark):
    df, pdf = _log(spark)
    got = global_row_number(df, ["ts", "id"], "rn", partitions=7).toPandas().set_index("id")["rn"]
    exp = pdf.sort_values(["ts", "id"]).assign(rn=np.arange(1, len(pdf) + 1)).set_index("id")["rn"]
    assert (got.sort_index() == exp.sort_index()).all()


def test_previous_row(spark):
    df, pdf = _log(spark)
    got = previous_row(df, ["model"], [F.col("ts"), F.col("id")], ["v"], partitions=5).toPandas().set_index("id")
    exp = pdf.sort_values(["model", "ts", "id"]).assign(prev=lambda x: x.groupby("model")["v"].shift()).set_index("id")
    pd.testing.assert_series_equal(got["prev_v"].sort_index(), exp["prev"].sort_index(), check_names=False)


@pytest.mark.parametrize("chunk", [7, 1_000_000])
def test_running_min_across_chunks(spark, chunk):
    df, pdf = _log(spark)
    got = running_extreme(df, ["model"], [F.col("ts"), F.col("id")], "v", "min", chunk_rows=chunk, partitions=5)
    got = got.toPandas().set_index("id")["running"].sort_index()
    s = pdf.sort_values(["model", "ts", "id"])
    exp = s.groupby("model")["v"].transform(lambda x: x.cummin().shift()).rename("running")
    exp.index = s["id"].values
    pd.testing.assert_series_equal(got, exp.sort_index(), check_names=False)


@pytest.mark.parametrize("chunk", [5, 1_000_000])
def test_asof_nearest_matches_brute_force(spark, chunk):
    left, lp = _log(spark, 300, 4)
    right, rp = _log(spark, 120, 5)
    got = asof_nearest(left, right.withColumnRenamed("id", "rid"), ["model"], "ts", "id", "rid",
                       chunk_rows=chunk, partitions=5)
    got = got.toPandas().set_index("rid")["id"].sort_index()
    exp = {}
    for _, r in rp.iterrows():
        cand = lp[lp.model == r.model]
        before = cand[cand.ts <= r.ts].sort_values(["ts", "id"])
        after = cand[cand.ts > r.ts].sort_values(["ts", "id"])
        p = before.iloc[-1] if len(before) else None
        n = after.iloc[0] if len(after) else None
        if n is None or (p is not None and (r.ts - p.ts) <= (n.ts - r.ts)):
            exp[r.id] = p.id if p is not None else None
        else:
            exp[r.id] = n.id
    exp = pd.Series(exp).sort_index()
    assert list(got.values) == list(exp.values)
