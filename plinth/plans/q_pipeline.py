"""Queries for the composed jobs (P01-P04) and the stage-table round trips."""

from __future__ import annotations

import functools
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.plans import pipeline as pl
from plinth.plans.catalog import register
from plinth.plans.common import filled, round_doubles
from plinth.plans.facts import FILLED_CTE, input_signature, order_facts
from plinth.session import scratch_path
from plinth.sources import files as fs


_BASES: dict[str, str] = {}


def _stage8(spark, d, fe=True):
    """Stage 8 of the input; queries of one session resume each other's runs (not with ``PLINTH_STAGE_CACHE=0``)."""
    facts = order_facts(spark, d)
    if os.environ.get("PLINTH_STAGE_CACHE", "1") == "0":
        base, mark = scratch_path(spark, "pipeline"), None
    else:
        base = _BASES.setdefault(spark.sparkContext.applicationId, scratch_path(spark, "pipeline"))
        mark = json.dumps([d, input_signature(spark, d)])
    tr, ts, gates = pl.preprocess(spark, facts, base, feature_engineering=fe, input_id=mark)
    return tr, ts, gates, base


def _both(tr, ts):
    return tr.select(F.lit(True).alias("is_train"), "*").unionByName(
        ts.select(F.lit(False).alias("is_train"), "*"), allowMissingColumns=True)


@register("p01_preprocess")
def p01_preprocess(spark, d):
    tr, ts, _, _ = _stage8(spark, d)
    return _both(tr, ts)


@register("p01_stage_gates")
def p01_stage_gates(spark, d):
    _, _, gates, _ = _stage8(spark, d)
    return functools.reduce(DataFrame.unionByName, gates)


@register("p02_preprocess_raw")
def p02_preprocess_raw(spark, d):
    tr, ts, _, _ = _stage8(spark, d, fe=False)
    return _both(tr, ts)


def _model_inputs(spark, d):
    tr, ts, _, base = _stage8(spark, d)
    feats = [c for c in tr.columns if c not in ("okey", "y", "custkey") and c in ts.columns]
    return tr, ts, feats, base


@register("p03_train_and_submit")
def p03_train_and_submit(spark, d):
    tr, ts, feats, base = _model_inputs(spark, d)
    sub, _, _ = pl.train_and_submit(spark, tr, ts, feats, base)
    return sub


@register("p04_ensemble")
def p04_ensemble(spark, d):
    tr, ts, feats, _ = _model_inputs(spark, d)
    return pl.ensemble(spark, tr, ts, feats, "stack")


@register("p04_blend")
def p04_blend(spark, d):
    tr, ts, feats, _ = _model_inputs(spark, d)
    return pl.ensemble(spark, tr, ts, feats, "blend")


# ---------------------------------------------------------------- A03 / A04
A03_SQL = f"WITH {FILLED_CTE} SELECT okey, is_train, round(y, 6) AS y FROM filled"


@register("a03_load_pair", A03_SQL)
def a03_load_pair(spark, d):
    base = scratch_path(spark, "pair")
    f = filled(spark, d).select("okey", "is_train", "y")
    fs.save_stage(f.where("is_train"), base, 3, True)
    fs.save_stage(f.where("NOT is_train"), base, 3, False)
    tr, ts = fs.load_pair(spark, base, 3)
    return round_doubles(tr.unionByName(ts))


A04_SQL = f"""WITH {FILLED_CTE} SELECT is_train, count(*) AS n, round(sum(y), 4) AS sum_y FROM filled GROUP BY is_train"""


@register("a04_save_stage", A04_SQL)
def a04_save_stage(spark, d):
    base = scratch_path(spark, "save")
    f = filled(spark, d).select("okey", "is_train", "y")
    p = fs.save_stage(f, base, 4, True)
    back = spark.read.parquet(p)
    return back.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 4).alias("sum_y"))
