import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.functions.quantile import (complement_quantiles, global_quantiles, group_quantiles, image, quantiles_by_groupings,
                                       sorted_quantiles, value_of)

INF = float("inf")


def _frame(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    # a hot group holding most rows, a small one, heavy ties, one row, infinities, extremes, many decades, a NULL key
    groups = {"hot": rng.exponential(10, 3000), "small": rng.normal(size=37), "ties": rng.integers(0, 3, 500).astype(float),
              "one": np.array([4.0]), "inf": np.array([*range(100), INF], float), "both": np.array([-INF, -1, 0, 1, INF]),
              "huge": np.array([-1.5e308, 1.5e308, 0.0, 1e300]), "tiny": np.array([5e-324, 1e-310, -5e-324, 0.0, 2.3e-308]),
              "decades": np.array([s * 10.0**k for k in range(-300, 300) for s in (1, -1)]), None: rng.normal(size=400)}
    for g, vals in groups.items():
        rows += [(g, float(v)) for v in vals]
    rows += [("hot", None), (None, None), ("none", None)]
    return spark.createDataFrame(rows, "g string, x double"), groups


def _want(vals, p):
    """Linear interpolation between order statistics, infinite only where a value is."""
    v = np.sort(vals)
    h = p * (len(v) - 1)
    a, b, f = v[int(h)], v[min(int(h) + 1, len(v) - 1)], h - int(h)
    return a if f == 0 or a == b else a * (1 - f) + b * f


def _check(got, groups, probs):
    assert set(got) == {(g, i) for g in groups for i in range(len(probs))}
    for g, vals in groups.items():
        for i, p in enumerate(probs):
            want = _want(vals, p)
            if np.isnan(want):
                assert np.isnan(got[(g, i)])
            else:
                assert got[(g, i)] == pytest.approx(want, rel=1e-9, abs=1e-290 if g == "decades" else 1e-320)


@pytest.mark.parametrize("leaf,k,want", [(250_000, 4096, 2), (3000, 256, 2), (50, 512, 3), (2, 256, 4)])
def test_group_quantiles_at_any_limit(spark, leaf, k, want):
    df, groups = _frame(spark)
    probs, passes = [0.0, 0.1, 0.5, 0.9, 1.0], []
    got = {(r["g"], r["p_idx"]): r["q"] for r in group_quantiles(df, ["g"], "x", probs, leaf_rows=leaf, k=k, passes=passes).collect()}
    _check(got, groups, probs)
    assert len(passes) <= want


def test_two_passes_where_most_rows_are_equal(spark):
    rows = spark.range(0, 400_000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pmod(F.col("id") * 7919, F.lit(99_991)) / 7.0).alias("x"))
    passes, probs = [], [i / 20 for i in range(1, 20)]
    got = [r["q"] for r in group_quantiles(rows, [], "x", probs, passes=passes).orderBy("p_idx").collect()]
    ids = np.arange(400_000)
    values = np.where(ids % 3 == 0, 7.0, (ids * 7919 % 99_991) / 7.0)
    assert got == pytest.approx([_want(values, p) for p in probs], rel=1e-12) and passes == ["sketch", "collect"]


def test_a_rank_that_its_bracket_misses_is_found(spark, monkeypatch):
    monkeypatch.setattr("plinth.functions.quantile.margins", lambda k: (9, 10))
    values = np.random.default_rng(4).permutation(50_000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert global_quantiles(df, "x", [0.1, 0.5, 0.77], k=256) == pytest.approx([_want(values, p) for p in (0.1, 0.5, 0.77)])


@pytest.mark.parametrize("leaf,k,want", [(250_000, 4096, 2), (3000, 256, 2), (2, 256, 4)])
def test_quantiles_outside_each_part(spark, leaf, k, want):
    df, groups = _frame(spark, 5)
    df = df.withColumn("part", F.when(F.col("g") == "one", 0).otherwise(F.pmod(F.xxhash64("x"), F.lit(4)).cast("int")))
    df = df.withColumn("part", F.when(F.col("part") == 3, None).otherwise(F.col("part"))).persist()
    passes, probs = [], [0.25, 0.5]
    got = {(r["g"], r["part"], r["whole"], r["p_idx"]): r["q"] for r in
           complement_quantiles(df, ["g"], "part", "x", probs, leaf_rows=leaf, k=k, passes=passes).collect()}
    rows, want_q = [r for r in df.collect() if r["x"] is not None], {}
    for g in groups:
        own = [(r["part"], r["x"]) for r in rows if r["g"] == g]
        for slot in [(None, True), *((p, False) for p in {p for p, _ in own})]:
            left = np.array([x for p, x in own if slot[1] or p != slot[0]])
            for i, p in enumerate(probs):
                if left.size:
                    want_q[g, *slot, i] = _want(left, p)
    assert set(got) == set(want_q)
    assert all(got[s] == pytest.approx(q, rel=1e-9, abs=1e-320) or np.isnan(got[s]) and np.isnan(q) for s, q in want_q.items() if s[0] != "decades")
    assert len(passes) <= want
    df.unpersist()


def test_sorted_quantiles_agree(spark):
    df, groups = _frame(spark, 1)
    probs = [i / 20 for i in range(21)]
    _check({(r["g"], r["p_idx"]): r["q"] for r in sorted_quantiles(df, ["g"], "x", probs).collect()}, groups, probs)


def test_many_probabilities_take_the_sort_and_agree(spark):
    df, groups = _frame(spark, 2)
    probs = [i / 64 for i in range(65)]
    many = {(r["g"], r["p_idx"]): r["q"] for r in group_quantiles(df, ["g"], "x", probs).collect()}
    few = {(r["g"], r["p_idx"]): r["q"] for r in group_quantiles(df, ["g"], "x", probs[:64], leaf_rows=100).collect()}
    assert set(few) < set(many)
    assert all(many[k] == few[k] or (np.isnan(many[k]) and np.isnan(few[k])) for k in few)


def test_image_keeps_the_order_of_doubles(spark):
    rng = np.random.default_rng(3)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 2.0, np.nextafter(2.0, 0), np.nextafter(2.0, 3),
              1.7976931348623157e308, INF, *rng.standard_normal(300), *np.exp(rng.uniform(-700, 700, 300)), *(2.0 ** np.arange(-1074, 1024, 13))]
    values += [-v for v in values]
    got = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", image(F.col("x")).alias("i"), value_of(image(F.col("x"))).alias("back")).collect()
    bits = lambda v: int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1)
    assert all(r["i"] == bits(r["x"]) and r["back"] == r["x"] for r in got)


def test_global_and_grouped_quantiles_in_one_run(spark):
    df, groups = _frame(spark, 2)
    vals = np.concatenate(list(groups.values()))
    got = global_quantiles(df, "x", [0.25, 0.75])
    assert got == pytest.approx([_want(vals, 0.25), _want(vals, 0.75)])
    per, overall = quantiles_by_groupings(df, {"g": ["x"]}, [0.5], leaf_rows=100)
    assert {r["gval"]: r["q"] for r in per.collect()}["small"] == pytest.approx(_want(groups["small"], 0.5))
    assert overall.first()["q"] == pytest.approx(_want(vals, 0.5))
