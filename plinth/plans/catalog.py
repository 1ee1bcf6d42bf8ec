"""Registered queries and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole test tables;
``ORACLES[name]`` is the same computation in plain SQL over the pre-registered
views.  Queries of randomised/iterative operators have no oracle.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plinth.functions.sizing import release_held

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # queries are independent jobs: intermediates that the library cached for earlier
            # ones are released first (the caller's caches and stage tables are not affected)
            release_held()
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the query modules (each registers itself)."""
    from plinth.plans import (  # noqa: F401
        q_clean_features,
        q_groups_encode,
        q_evaluate,
        q_folds_target,
        q_quality,
        q_runlog,
        q_models,
        q_sources,
        q_shape_cluster,
        q_pipeline,
    )
