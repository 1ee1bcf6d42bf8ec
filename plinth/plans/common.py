"""Shared building blocks for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions.sizing import broadcast_if_small, hold
from plinth.operators.clean import fill_missing
from plinth.operators.evaluate import error_columns
from plinth.operators.features import with_columns
from plinth.plans.facts import FILLED_CTE, order_facts

DIGITS = 6


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (results are compared across engines)."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B01 applied to the order facts (``first_ship`` keeps its NULLs: not numeric, not text)."""
    return fill_missing(order_facts(spark, sf_dir), exclude=("okey", "custkey", "is_train"))


def group_mean_tables(train: DataFrame, groups: list[str], value: str = "y"):
    """Means of ``value`` per group for several group columns AND the global mean in ONE
    aggregate (grouping sets).  Returns ``({group: table}, global_mean, n_rows)``."""
    sets = [[g] for g in groups] + [[]]
    gs = train.groupingSets(sets, *groups).agg(F.avg(value).alias("_m"), F.grouping_id().alias("_gid"))
    gs = hold(gs)
    n = gs.count()
    full = (1 << len(groups)) - 1
    glob = gs.where(F.col("_gid") == full).first()["_m"]
    tables = {}
    for i, g in enumerate(groups):
        gid = full & ~(1 << (len(groups) - 1 - i))
        tables[g] = gs.where(F.col("_gid") == gid).select(g, "_m")
    return tables, glob, n


def nation_mean_predictions(f: DataFrame) -> DataFrame:
    """A simple fitted predictor: train mean of ``y`` per nation, unseen -> global train mean.
    Adds ``pred`` and the L02 error columns."""
    tables, glob, n = group_mean_tables(f.where("is_train"), ["nation"])
    j = f.join(broadcast_if_small(tables["nation"].withColumnRenamed("_m", "_gm"), bound=n), "nation", "left")
    j = j.withColumn("pred", F.coalesce(F.col("_gm"), F.lit(glob))).drop("_gm")
    return with_columns(j, error_columns(F.col("y"), F.col("pred")))


ERRORS_CTE = FILLED_CTE + """,
gm AS (SELECT nation, avg(y) AS m FROM filled WHERE is_train GROUP BY nation),
gl AS (SELECT avg(y) AS m FROM filled WHERE is_train),
predicted AS (
  SELECT f.*, coalesce(gm.m, gl.m) AS pred
  FROM filled f LEFT JOIN gm ON gm.nation = f.nation CROSS JOIN gl
),
errors AS (
  SELECT *, y - pred AS error_log, abs(y - pred) AS error_log_abs,
         (exp(y) - 1) - (exp(pred) - 1) AS error_real,
         abs((exp(y) - 1) - (exp(pred) - 1)) AS error_real_abs,
         ((exp(y) - 1) - (exp(pred) - 1)) / (exp(y) - 1) * 100 AS error_real_pct,
         exp(y) - 1 AS y_true_real, exp(pred) - 1 AS y_pred_real
  FROM predicted
)"""
