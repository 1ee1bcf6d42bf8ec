"""Group-relative features fitted on the training part: D01, D02.

A fit is one aggregate per group key (configs that share a key share the
aggregate); the result is a parameter table joined back with a left join
(broadcast when its row count is proven small).  Medians use the exact
histogram-refinement quantile so a hot group never sits in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.quantile import quantiles_by_groupings, quantiles_with_global
from plinth.functions.sizing import broadcast_if_small
from plinth.operators.features import col

# The reference's benchmark configurations (group, value, statistic).
HOUSE_BENCHMARKS = [
    ("Neighborhood", "TotalSF", "median"),
    ("Neighborhood", "OverallQual", "mean"),
    ("Neighborhood", "Age", "median"),
    ("MSSubClass", "TotalSF", "median"),
    ("MSZoning", "LotArea", "median"),
    ("OverallQual", "TotalSF", "median"),
    ("Decade", "TotalSF", "median"),
]


def _fit_stats(train: DataFrame, group: str, values: Sequence[str], stat: str) -> tuple[DataFrame, dict]:
    """Group table ``group, v1, v2, ...`` and the global values, for mean or median."""
    if stat == "mean":
        table = train.groupBy(col(group)).agg(*[F.avg(col(v)).alias(v) for v in values])
        glob = train.agg(*[F.avg(col(v)).alias(v) for v in values]).first().asDict()
        return table, glob
    if stat == "median":
        per_group, overall = quantiles_with_global(train, group, values, [0.5])
        table = per_group.groupBy(col(group)).agg(
            *[F.max(F.when(F.col("column") == v, F.col("q"))).alias(v) for v in values])
        got = {r["column"]: r["q"] for r in overall.collect()}
        return table, {v: got.get(v) for v in values}
    raise ValueError(f"unknown statistic {stat!r}")


def fit_group_benchmarks(train: DataFrame, configs: Sequence[tuple[str, str, str]]):
    """D01 fit: per (group, stat) its value columns; all means of a group in one aggregate,
    and ALL medians (every group and the global ones) in one exact quantile run.

    Returns ``{(group, stat): (group_table, global_row_dict)}``.
    """
    by_key: dict[tuple[str, str], list[str]] = defaultdict(list)
    for g, v, s in configs:
        if g in train.columns and v in train.columns and v not in by_key[(g, s)]:
            by_key[(g, s)].append(v)
    params = {}
    medians = {g: vs for (g, s), vs in by_key.items() if s == "median"}
    if medians:
        per_group, overall = quantiles_by_groupings(train, medians, [0.5])
        got = {(r["grouping"], r["column"]): r["q"] for r in overall.collect()}  # one row per (group, column)
        types = dict(train.dtypes)
        for g, values in medians.items():
            table = per_group.where(F.col("grouping") == g).groupBy("gval").agg(
                *[F.max(F.when(F.col("column") == v, F.col("q"))).alias(v) for v in values])
            table = table.select(F.col("gval").cast(types[g]).alias(g), *values)
            params[(g, "median")] = (table, {v: got.get((g, v)) for v in values})
    for (g, s), values in by_key.items():
        if s == "mean":
            params[(g, s)] = _fit_stats(train, g, values, s)
        elif s != "median":
            raise ValueError(f"unknown statistic {s!r}")
    return params


def apply_group_benchmarks(df: DataFrame, configs: Sequence[tuple[str, str, str]], params) -> DataFrame:
    """D01 apply: ratio ``x / benchmark`` (NaN/Inf/NULL -> 1.0) or, for ``Age``, the difference.

    Unseen groups and zero benchmarks fall back to the global statistic (0 -> 1.0).
    """
    out = df
    specs = []
    for (g, s), (table, glob) in params.items():
        prefix = f"_b_{g}_{s}_"
        renamed = table.select(col(g), *[col(v).alias(prefix + v) for v in table.columns if v != g])
        out = out.join(broadcast_if_small(renamed), on=g, how="left")
        for cg, v, cs in configs:
            if (cg, cs) != (g, s) or v not in glob:
                continue
            fallback = glob[v] if glob[v] not in (None, 0) else 1.0
            bench = F.coalesce(col(prefix + v), F.lit(float(fallback)))
            bench = F.when(bench == 0, F.lit(float(fallback))).otherwise(bench)
            if v == "Age":
                specs.append((f"Age_vs_{g}_Avg", col(v) - bench))
            else:
                ratio = F.try_divide(col(v).cast("double"), bench)
                specs.append((f"{v}_to_{g}_Ratio", F.coalesce(F.nanvl(ratio, F.lit(None).cast("double")), F.lit(1.0))))
    temp = [c for c in out.columns if c.startswith("_b_")]
    return out.select(*[col(c) for c in df.columns], *[c.alias(n) for n, c in specs]).drop(*temp)


def group_benchmarks(train: DataFrame, frames: Sequence[DataFrame], configs=HOUSE_BENCHMARKS) -> list[DataFrame]:
    """Fit on ``train``, apply to every frame in ``frames``."""
    params = fit_group_benchmarks(train, configs)
    return [apply_group_benchmarks(f, configs, params) for f in frames]


def group_means(train: DataFrame, df: DataFrame, group: str, values: Sequence[str],
                mean_suffix: str = "_GroupMean", ratio_suffix: str = "_to_GroupMean") -> DataFrame:
    """Per-group means of several columns in one aggregate, joined back;
    unseen groups use the global mean; adds ``x / (mean + 1)`` ratios."""
    table = train.groupBy(col(group)).agg(*[F.avg(col(v)).alias(f"_m_{v}") for v in values])
    glob = train.agg(*[F.avg(col(v)).alias(v) for v in values]).first().asDict()
    j = df.join(broadcast_if_small(table), on=group, how="left")
    specs = []
    for v in values:
        m = F.coalesce(col(f"_m_{v}"), F.lit(glob[v]))
        specs.append((f"{v}{mean_suffix}", m))
        specs.append((f"{v}{ratio_suffix}", F.coalesce(F.try_divide(col(v).cast("double"), m + 1), F.lit(0.0))))
    return j.select(*[col(c) for c in df.columns], *[c.alias(n) for n, c in specs])
