"""Scaling and categorical encoding (stages 5, 6 and the scaling in 8): C01, F01-F04."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions.distinct import few_values, many_values
from plinth.operators.clean import is_numeric, text_columns
from plinth.operators.features import col, with_columns


def distinct_ratios(df: DataFrame, min_ratio: float = 0.05, exclude: Iterable[str] = (),
                    exact: bool = True) -> DataFrame:
    """C01 as a table: ``column, n_unique, n_rows, ratio, continuous`` for the int64/float64
    columns.  ``nunique`` skips NULLs, ``n_rows`` does not (pandas).  One aggregate for
    all columns; ``exact=False`` uses HyperLogLog sketches for very wide/long tables.
    """
    ex = set(exclude)
    cands = [f.name for f in df.schema.fields if f.name not in ex
             and isinstance(f.dataType, (T.LongType, T.IntegerType, T.DoubleType, T.FloatType))]
    cnt = F.count_distinct if exact else F.approx_count_distinct
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[cnt(col(c)).alias(f"c{i}") for i, c in enumerate(cands)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").cast("long").alias("n_unique")) for i, c in enumerate(cands)
    ]))
    out = row.select(F.col("_n").alias("n_rows"), stack.alias("s")).select("s.column", "s.n_unique", "n_rows")
    ratio = F.try_divide(F.col("n_unique").cast("double"), F.col("n_rows"))
    return out.withColumn("ratio", ratio).withColumn("continuous", F.coalesce(ratio > min_ratio, F.lit(False)))


def continuous_columns(df: DataFrame, min_ratio: float = 0.05, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the continuous columns: those of :func:`distinct_ratios`, by sketches, with exact counts only for
    columns near the ratio."""
    ex = set(exclude)
    cands = [f.name for f in df.schema.fields if f.name not in ex
             and isinstance(f.dataType, (T.LongType, T.IntegerType, T.DoubleType, T.FloatType))]
    return many_values(df, cands, min_ratio)


def fit_standard_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """F01 fit: mean and POPULATION std per column in one aggregate (sklearn semantics).

    A zero (or undefined) std scales by 1.
    """
    if not cols:
        return {}
    row = train.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def apply_standard_scaler(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """F01 apply: ``(x - mean) / std`` as literal expressions (codegen, no join)."""
    specs = [(f"{c}{suffix}", (col(c) - F.lit(m)) / F.lit(s)) for c, (m, s) in params.items() if c in df.columns]
    return with_columns(df, specs)


def cardinality_table(frames: Sequence[DataFrame], max_levels: int = 10, exclude: Iterable[str] = ()) -> DataFrame:
    """F02 as a table: ``column, n_levels, cardinality`` ('low'/'high') for the text
    columns common to all frames, distinct counts over their union in one aggregate."""
    base = frames[0]
    cols = [c for c in text_columns(base, exclude) if all(c in f.columns for f in frames)]
    u = None
    for f in frames:
        part = f.select(*[col(c) for c in cols])
        u = part if u is None else u.unionByName(part)
    row = u.agg(*[F.count_distinct(col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").cast("long").alias("n_levels")) for i, c in enumerate(cols)
    ]))
    out = row.select(stack.alias("s")).select("s.*")
    return out.withColumn("cardinality", F.when(F.col("n_levels") <= max_levels, "low").otherwise("high"))


def cardinality_split(frames: Sequence[DataFrame], max_levels: int = 10, exclude: Iterable[str] = ()):
    """non-numeric columns split into (low, high) by distinct count over all frames (as in
    :func:`cardinality_table`); only columns with about ``max_levels`` values or fewer are counted exactly."""
    cols = [c for c in text_columns(frames[0], exclude) if all(c in f.columns for f in frames)]
    if not cols:
        return [], []
    u = frames[0].select(*[col(c) for c in cols])
    for f in frames[1:]:
        u = u.unionByName(f.select(*[col(c) for c in cols]))
    low = few_values(u, cols, max_levels)
    return [c for c in cols if c in low], [c for c in cols if c not in low]


def fit_one_hot(frames: Sequence[DataFrame], cols: Sequence[str]) -> dict[str, list[str]]:
    """F03 fit: sorted distinct levels of each column over the union of ``frames``.

    Only called for low-cardinality columns, so each collected set is bounded by
    the split threshold.
    """
    if not cols:
        return {}
    u = None
    for f in frames:
        part = f.select(*[col(c) for c in cols])
        u = part if u is None else u.unionByName(part)
    row = u.agg(*[F.sort_array(F.collect_set(col(c))).alias(f"l{i}") for i, c in enumerate(cols)]).first()
    return {c: list(row[f"l{i}"]) for i, c in enumerate(cols)}


def apply_one_hot(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = True) -> DataFrame:
    """F03 apply: ``col_level`` byte dummies (first level dropped), originals removed."""
    specs = []
    for c, lv in levels.items():
        for level in (lv[1:] if drop_first else lv):
            specs.append((f"{c}_{level}", F.when(col(c) == level, 1).otherwise(0).cast("byte")))
    return with_columns(df, specs, drop=list(levels))


def one_hot_encode(train: DataFrame, test: DataFrame, max_levels: int = 10, exclude: Iterable[str] = ()):
    """F02 + F03: encode low-cardinality text columns of the pair, keep high-cardinality ones."""
    low, _high = cardinality_split([train, test], max_levels, exclude)
    levels = fit_one_hot([train, test], low)
    return apply_one_hot(train, levels), apply_one_hot(test, levels)


def scale_new_columns(train: DataFrame, test: DataFrame, before: Iterable[str], name_filter=None,
                      exclude: Iterable[str] = ()):
    """standardise the numeric columns created since ``before`` (optionally filtered by name)."""
    before, ex = set(before), set(exclude)
    new = [f.name for f in train.schema.fields
           if f.name not in before and f.name not in ex and is_numeric(f.dataType)
           and (name_filter is None or name_filter(f.name))]
    params = fit_standard_scaler(train, new)
    return apply_standard_scaler(train, params), apply_standard_scaler(test, params), new
