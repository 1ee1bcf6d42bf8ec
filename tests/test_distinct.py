import pytest
from pyspark.sql import functions as F

from plinth.functions import distinct
from plinth.operators import encode


@pytest.fixture(scope="module")
def wide(spark):
    n = 20_000
    counts = [0, 1, 9, 10, 11, 12, 200, 990, 1000, 1001, 1010, 5000, n]
    cols = [(F.col("id") % max(c, 1) if c else F.lit(None).cast("long")).alias(f"c{c}") for c in counts]
    rows = spark.range(0, n, 1, 4).select("id", *cols)
    text = [F.col(f"c{c}").cast("string").alias(f"t{c}") for c in counts]
    null = F.when(F.col("id") % 2 == 0, F.col("c1010")).alias("half")
    return rows.select(*[f"c{c}" for c in counts], *text, null).persist()


def test_decisions_equal_the_exact_tables(wide):
    want = [r["column"] for r in encode.distinct_ratios(wide, 0.05).where("continuous").collect()]
    assert encode.continuous_columns(wide, 0.05) == want == ["c1001", "c1010", "c5000", "c20000"]
    low, high = encode.cardinality_split([wide.limit(100), wide], 10)
    assert low == ["t0", "t1", "t9", "t10"] and high == ["t11", "t12", "t200", "t990", "t1000", "t1001", "t1010", "t5000", "t20000"]
    assert distinct.few_values(wide, ["c0", "c9", "c10", "c11"], 10) == {"c0": 0, "c9": 9, "c10": 10}


def test_sketches_run_without_expanding_rows(wide, monkeypatch):
    plans = []
    first = type(wide).first
    monkeypatch.setattr(type(wide), "first", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), first(df))[1])
    assert encode.continuous_columns(wide.select("c9", "c200", "c5000", "c20000"), 0.05) == ["c5000", "c20000"]
    encode.cardinality_split([wide], 10)
    assert len(plans) == 3 and not any("Expand" in p for p in plans)


def test_empty_tables_and_no_columns(wide):
    assert encode.continuous_columns(wide.limit(0).select("c9"), 0.05) == []
    assert encode.cardinality_split([wide.limit(0).select("t9")], 10) == (["t9"], [])
    assert encode.continuous_columns(wide.select("t9"), 0.05) == [] and encode.cardinality_split([wide.select("c9")], 10) == ([], [])
