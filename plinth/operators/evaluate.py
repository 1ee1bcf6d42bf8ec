"""Metrics and error analysis: L01-L10."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.quantile import global_quantiles, group_quantiles
from plinth.operators.features import col


def regression_metrics(df: DataFrame, y: str, pred: str, log_target: bool = True,
                       real_clip: tuple[float, float] = (0.0, 1e7)) -> DataFrame:
    """MSE/RMSE in log space, and RMSE in real space (``expm1``, predictions
    clipped to ``real_clip``) -- the reference's ``rmse_real`` scorer.  One aggregate."""
    d = col(y) - col(pred)
    out = [F.avg(d * d).alias("mse"), F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("n")]
    if log_target:
        pr = F.least(F.greatest(F.expm1(col(pred)), F.lit(real_clip[0])), F.lit(real_clip[1]))
        dr = F.expm1(col(y)) - pr
        out.append(F.sqrt(F.avg(dr * dr)).alias("rmse_real"))
    return df.agg(*out)


def error_columns(y_log: Column, pred_log: Column) -> list[tuple[str, Column]]:
    """Per-row errors in log and real space (``y - pred``), absolute and percent."""
    yr, pr = F.expm1(y_log), F.expm1(pred_log)
    e = y_log - pred_log
    er = yr - pr
    return [
        ("error_log", e),
        ("error_log_abs", F.abs(e)),
        ("error_real", er),
        ("error_real_abs", F.abs(er)),
        ("error_real_pct", F.try_divide(er, yr) * 100),
        ("y_true_real", yr),
        ("y_pred_real", pr),
    ]


def _segment_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("count"),
        F.avg("error_log_abs").alias("mean_error_log_abs"),
        F.avg("error_real_abs").alias("mean_error_real_abs"),
        F.avg(F.abs("error_real_pct")).alias("mean_error_pct"),
        F.stddev_samp("error_log_abs").alias("std_error_log_abs"),
    ]


def quantile_bin_edges(df: DataFrame, feature: str, n_bins: int = 10) -> list[float]:
    """Distinct ``qcut`` edges (linear interpolation), at most ``n_bins + 1`` values.

    Fewer bins when the column has fewer distinct values (as the reference does).
    """
    distinct = df.agg(F.count_distinct(col(feature)).alias("d")).first()["d"]
    n = max(1, min(n_bins, distinct))
    qs = global_quantiles(df, feature, [i / n for i in range(n + 1)])
    edges = sorted({q for q in qs if q is not None})
    return edges


def bin_expr(feature: str, edges: Sequence[float]) -> Column:
    """Right-closed bins ``(e[j-1], e[j]]``, the first one closed on the left (1-based)."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    return F.greatest(F.lit(1), F.size(F.filter(arr, lambda e: e < col(feature).cast("double"))))


def errors_by_feature(errors: DataFrame, feature: str, n_bins: int = 10, categorical: bool | None = None) -> DataFrame:
    """Error summary per category, or per quantile bin of a numeric feature.

    ``errors`` carries the L02 columns and ``feature``.  Numeric bins come from
    exact distributed quantiles (the edges are a handful of scalars); the
    grouping itself is one partial aggregate.  Worst segment first.
    """
    dtype = dict(errors.dtypes)[feature]
    if categorical is None:
        categorical = dtype == "string"
    if categorical:
        out = errors.groupBy(col(feature).cast("string").alias("feature_value")).agg(*_segment_aggs())
        return out.orderBy(F.desc("mean_error_log_abs"), "feature_value")
    edges = quantile_bin_edges(errors, feature, n_bins)
    binned = errors.where(col(feature).isNotNull()).withColumn("bin", bin_expr(feature, edges))
    out = binned.groupBy("bin").agg(*_segment_aggs())
    lower = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), F.col("bin"))
    upper = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), F.least(F.col("bin") + 1, F.lit(len(edges))))
    out = out.select("bin", lower.alias("lower"), upper.alias("upper"), *[c for c in out.columns if c != "bin"])
    return out.orderBy(F.desc("mean_error_log_abs"), "bin")


def worst_rows(errors: DataFrame, features: DataFrame, key: str, n: int = 50) -> DataFrame:
    """The ``n`` rows with the largest absolute log error joined to their features.

    Top-k is the feature here: ``orderBy().limit()`` plans as TakeOrderedAndProject
    (each task keeps its own top ``n``), then a join on the key for the features.
    """
    top = errors.orderBy(F.desc("error_log_abs"), col(key)).limit(n)
    return top.join(features, on=key, how="left")


def error_summary(errors: DataFrame) -> DataFrame:
    """Overall MAE (log, real), MAPE and log RMSE in one aggregate."""
    return errors.agg(
        F.avg("error_log_abs").alias("mae_log"),
        F.avg("error_real_abs").alias("mae_real"),
        F.avg(F.abs("error_real_pct")).alias("mape"),
        F.sqrt(F.avg(F.col("error_log") * F.col("error_log"))).alias("rmse_log"),
        F.count(F.lit(1)).alias("n"),
    )


def feature_suggestions(worst: DataFrame, year_col: str, year_cut: int, by_group: DataFrame | None = None,
                        share: float = 0.3, top: int = 5, quality: str | None = None, remodelled: str | None = None,
                        by_quality: DataFrame | None = None, this_year: int = 2024) -> DataFrame:
    """Rule table ``(rule, fired, detail)`` from conditional aggregates over the worst rows.

    Rules on a column that is not named or not there do not appear; ``by_quality`` (errors by the
    quality column) brings in its square."""
    row = worst.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.when(col(year_col) > year_cut, 1).otherwise(0)).alias("new")).first()
    n, new = row["n"] or 0, row["new"] or 0
    rules = [(f"Is_New = {year_col} > {year_cut}", bool(n and new > n * share), f"{new}/{n}")]
    if by_group is not None:
        names = [r[0] for r in by_group.orderBy(F.desc("mean_error_log_abs"), "feature_value").limit(top).collect()]
        rules.append(("HighError groups", bool(names), ", ".join(map(str, names))))
    if quality in worst.columns:
        rules.append(("Quality x age", True, f"{quality} * ({this_year} - {year_col})"))
    if remodelled in worst.columns:
        rules.append(("Remodel age", True, f"{remodelled} - {year_col}"))
        rules.append(("Is remodelled", True, f"{remodelled} != {year_col}"))
    if by_quality is not None and not by_quality.isEmpty():
        rules.append(("Squared quality", True, f"{quality} ** 2"))
    return worst.sparkSession.createDataFrame(rules, "rule string, fired boolean, detail string")


def prediction_correlations(wide: DataFrame, models: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Pairwise correlation of prediction columns in one aggregate, long form;
    ``high`` marks pairs above ``threshold``."""
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i + 1:]]
    row = wide.agg(*[F.corr(col(a), col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]))
    out = row.select(stack.alias("s")).select("s.*")
    return out.withColumn("high", F.col("corr") > threshold)


def melt_predictions(wide: DataFrame, key: str, models: Sequence[str], reference: DataFrame | None = None,
                     ref_value: str | None = None, ref_name: str = "train") -> DataFrame:
    """Wide predictions -> long ``(key, model, value)``, optionally with the training
    target appended as one more "model"."""
    long = wide.unpivot([key], list(models), "model", "value")
    if reference is not None and ref_value:
        ref = reference.select(col(key), F.lit(ref_name).alias("model"), col(ref_value).cast("double").alias("value"))
        long = long.unionByName(ref)
    return long


def distribution_by_model(long: DataFrame, exploded_mean: float = 1e7) -> DataFrame:
    """Per-model mean/median/std/min/max/q25/q75, dropping exploded models (mean >= 1e7).

    Quantiles use the exact distributed quantile (no model's values sit in one task).
    """
    base = long.groupBy("model").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("n"),
    )
    q = group_quantiles(long, ["model"], "value", [0.25, 0.5, 0.75]).groupBy("model").agg(
        F.max(F.when(F.col("p_idx") == 0, F.col("q"))).alias("q25"),
        F.max(F.when(F.col("p_idx") == 1, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p_idx") == 2, F.col("q"))).alias("q75"),
    )
    return base.join(q, "model").where(F.col("mean") < exploded_mean)


def pairwise_differences(wide: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """For each model pair: mean and std of the difference, max absolute difference, corr."""
    aggs = []
    for i, (a, b) in enumerate(pairs):
        d = col(a) - col(b)
        aggs += [F.avg(d).alias(f"m{i}"), F.stddev_samp(d).alias(f"s{i}"),
                 F.max(F.abs(d)).alias(f"x{i}"), F.corr(col(a), col(b)).alias(f"c{i}")]
    row = wide.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"m{i}").alias("mean_diff"),
                 F.col(f"s{i}").alias("std_diff"), F.col(f"x{i}").alias("max_abs_diff"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]))
    return row.select(stack.alias("s")).select("s.*")
