import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from plinth.operators import cluster


def planted(spark, seed=0, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-10, 10, (6, 3))
    x = np.concatenate([c + spread * rng.standard_normal((n, 3)) for c, n in zip(centres, (900, 300, 200, 100, 60, 40))])
    x = np.concatenate([x, np.repeat(x[:1], 800, axis=0)])  # one row makes up a third
    return x, spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(5)


def brute_cost(x, centres):
    z = (x - x.mean(0)) / x.std(0)
    return ((z[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_cost_is_at_most_that_of_the_best_single_fit(spark):
    x, df = planted(spark)
    z = (x - x.mean(0)) / x.std(0)
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame([tuple(map(float, r)) for r in z], "a double, b double, c double")).select("features")
    best = min(KMeans(k=6, seed=s, maxIter=50).fit(vec).summary.trainingCost for s in range(3))
    (centres, params, cost), = cluster.fit_many(df, {"all": (["a", "b", "c"], 6)}).values()
    assert centres.shape == (6, 3) and cost == pytest.approx(brute_cost(x, centres)) and cost <= best * (1 + 1e-6)
    got = cluster.assign_clusters(df, centres, params, ["a", "b", "c"], "cl", as_label=False).collect()
    want = ((((np.array([r[:3] for r in got]) - x.mean(0)) / x.std(0))[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert [r["cl"] for r in got] == want.tolist()


def test_passes_do_not_depend_on_restarts_or_sets(spark):
    _, df = planted(spark, 1, spread=0.05)
    few, many, again = [], [], []
    one = cluster.fit_many(df, {"s": (["a", "b"], 3)}, restarts=1, max_iter=4, tol=-1.0, passes=few)
    fits = {"s": (["a", "b"], 3), "t": (["b", "c"], 5), "u": (["a", "b", "c"], 2)}
    all_ = cluster.fit_many(df, fits, restarts=20, max_iter=4, tol=-1.0, passes=many)
    assert len(few) == len(many) == 1 + 2 * cluster.SEED_ROUNDS + 1 + 4 + 1
    assert all_["s"][2] <= one["s"][2] + 1e-9
    same = cluster.fit_many(df, fits, restarts=20, max_iter=4, tol=-1.0, passes=again)
    assert all(np.allclose(same[n][0], all_[n][0]) for n in fits)


def test_few_rows_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (None, 4.0), (float("nan"), 4.0)], "a double, b double")
    train, test = cluster.kmeans_feature(df, df.limit(0), ["a", "b"], k=4)
    labels = [r["Cluster"] for r in train.orderBy("b").collect()]
    assert labels[0] == labels[1] != labels[2] == labels[3] and not test.collect()
    train, _ = cluster.multi_kmeans(df.limit(0), df, {"S": (["a", "b"], [2]), "T": (["a", "missing"], [2])})
    assert train.columns == ["a", "b", "S_k2"] and not train.collect()
