"""The operators' registered queries ``opN_<name>`` and their DuckDB SQL, where SQL can express one."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plinth.llm import bpe, exact_dedup, html_extract, near_dedup, ngram_lm, packing, quality, resample, runs, toxicity, url_rules, variants, warc
from plinth.llm.text import worker_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        worker_path(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    if sql is not None:
        ORACLES[fn.__name__] = sql


_register(html_extract.op1_html_extract)
_register(packing.op2_packing)
_register(near_dedup.op3_near_dedup)
_register(ngram_lm.op4_ngram_lm)
_register(exact_dedup.op5_exact_dedup, exact_dedup.SQL)
_register(bpe.op6_bpe)
_register(warc.op7_warc, warc.SQL)
_register(resample.op8_importance_resampling)
_register(quality.op9_quality_rules)
_register(toxicity.op10_toxicity)
_register(url_rules.op11_url_rules)
_register(runs.op12_periodic_runs)
_register(variants.op13_spelling_variants)
