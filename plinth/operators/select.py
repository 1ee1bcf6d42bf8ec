"""Feature importance and selection (stage 7): G01-G10.

Scores live in a long table ``(feature, method, score)`` so any number of
methods combine with one window and one aggregate.  Model-based scores (trees,
lasso, CV RMSE of a subset) come from MLlib fits over a ``fold`` column.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.operators.features import col
from plinth.operators.quality import correlations

# The reference's method weights for combining importances.
DEFAULT_WEIGHTS = {"xgboost": 2.0, "lightgbm": 2.0, "catboost": 2.0, "shap": 1.5, "correlation": 1.0, "lasso": 1.5}


def correlation_importance(df: DataFrame, target: str, features: Sequence[str], floor: float = 0.01,
                           method: str = "correlation") -> DataFrame:
    """``max(|corr(feature, target)|, floor)`` for every feature in one pass."""
    rows = [(f, method, c) for f, c in zip(features, correlations(df, target, features))]
    out = df.sparkSession.createDataFrame(rows, "feature string, method string, corr double")
    return out.select("feature", "method", F.greatest(F.abs(F.coalesce("corr", F.lit(0.0))), F.lit(floor)).alias("score"))


def combine_scores(scores: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Per method divide by its max (when its sum is positive), then the weighted mean
    over methods (weight 1.0 for methods not listed).  ``scores``: feature, method, score."""
    w = Window.partitionBy("method")  # one partition per method over a features-sized table
    norm = F.when(F.sum("score").over(w) > 0, F.col("score") / F.max("score").over(w)).otherwise(F.col("score"))
    weights = dict(weights or {})
    wexpr = F.lit(1.0)
    for m, v in weights.items():
        wexpr = F.when(F.col("method") == m, F.lit(float(v))).otherwise(wexpr)
    methods = scores.select("method").distinct()
    total = methods.select(F.sum(wexpr).alias("_tw")).first()["_tw"] or 0.0
    n = scores.withColumn("_n", norm).withColumn("_w", wexpr)
    out = n.groupBy("feature").agg(F.sum(F.col("_n") * F.col("_w")).alias("_s"))
    return out.select("feature", (F.col("_s") / F.lit(total) if total > 0 else F.col("_s")).alias("combined"))


def select_by_percentile(combined: DataFrame, percentile: float = 10.0, score: str = "combined") -> DataFrame:
    """Keep features scoring at least the ``percentile``-th percentile (linear interpolation)."""
    thr = combined.agg(F.percentile(col(score), percentile / 100.0).alias("t")).first()["t"]
    return combined.where(col(score) >= F.lit(thr))


def select_top_n(combined: DataFrame, n: int, score: str = "combined") -> DataFrame:
    """The ``n`` best features, ties by name."""
    return combined.orderBy(F.desc(col(score)), F.col("feature")).limit(n)


def correlation_pairs(df: DataFrame, features: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Pairs ``(f1, f2)`` (f1 before f2 in column order) with |Pearson corr| above ``threshold``.

    The matrix comes from MLlib's distributed ``Correlation.corr`` (one job); it is
    ``p x p`` for ``p`` features, so only the matrix (never row data) reaches the driver.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=list(features), outputCol="_v", handleInvalid="keep") \
        .transform(df.select(*[col(f).cast("double").alias(f) for f in features]))
    m = Correlation.corr(vec, "_v").first()[0].toArray()
    rows = [(features[i], features[j], float(m[i][j]))
            for i in range(len(features)) for j in range(i + 1, len(features)) if abs(m[i][j]) > threshold]
    return df.sparkSession.createDataFrame(rows, "f1 string, f2 string, corr double")


def remove_redundant(importance: DataFrame, pairs: DataFrame, score: str = "combined") -> tuple[DataFrame, DataFrame]:
    """From each highly correlated pair drop the less important feature (tie: the later
    one); a dropped feature still eliminates others.  Returns (kept, removed) via a
    left-anti join of the importance table against the removed set."""
    imp = importance.select(F.col("feature"), col(score).alias("_imp"))
    p = pairs.join(imp.withColumnRenamed("feature", "f1").withColumnRenamed("_imp", "i1"), "f1", "left") \
        .join(imp.withColumnRenamed("feature", "f2").withColumnRenamed("_imp", "i2"), "f2", "left")
    i1, i2 = F.coalesce("i1", F.lit(0.0)), F.coalesce("i2", F.lit(0.0))
    removed = p.select(F.when(i1 < i2, F.col("f1")).otherwise(F.col("f2")).alias("feature")).distinct()
    kept = importance.join(removed, "feature", "left_anti")
    return kept, removed


# ---------------------------------------------------------------- model-based scores (R)
def tree_importance(df: DataFrame, target: str, features: Sequence[str], fold: str = "fold", model: str = "gbt",
                    seed: int = 42, **params) -> DataFrame:
    """Per-fold MLlib tree ``featureImportances`` averaged over folds (one operator,
    ``model`` = ``gbt`` or ``rf``).  Folds train on ``fold != k``."""
    from plinth.operators.models import assemble, make_tree

    data = assemble(df, features).select("features", col(target).alias("label"), col(fold)).persist()
    folds = [r[0] for r in data.select(fold).distinct().orderBy(fold).collect()]
    acc = [0.0] * len(features)
    for k in folds:
        m = make_tree(model, seed=seed, **params).fit(data.where(col(fold) != k))
        imp = m.featureImportances.toArray()
        acc = [a + float(b) for a, b in zip(acc, imp)]
    data.unpersist()
    rows = [(f, model, acc[i] / max(1, len(folds))) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature string, method string, score double")


def lasso_importance(df: DataFrame, target: str, features: Sequence[str], fold: str = "fold",
                     alphas: Sequence[float] | None = None, method: str = "lasso") -> DataFrame:
    """|coefficients| of a lasso at the CV-chosen alpha.  Without ``alphas``: 100 of them, evenly spaced in
    the logarithm, from the least that leaves no feature down to a thousandth of it.

    One pass gives the folds' cross products, on which all alphas and folds are solved; one more
    pass scores them (``models.linear_grid``)."""
    import numpy as np

    from plinth.operators.models import fold_moments, linear_grid, solve_linear

    moments = fold_moments(df, features, target, fold)
    whole = functools.reduce(operator.add, moments.values())
    if alphas is None:
        top = np.abs(whole.g[:-1, -1] / whole.n - whole.s[:-1] * whole.s[-1] / whole.n**2).max()
        alphas = [float(a) for a in np.geomspace(top, top / 1000, 100)] if top > 0 else [1.0]
    best, _, _ = linear_grid(df, features, [{"kind": "lasso", "alpha": a} for a in alphas], target, fold, moments=moments)[0]
    coefs, _ = solve_linear(*whole, "lasso", best["alpha"])
    rows = [(f, method, abs(float(coefs[i]))) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature string, method string, score double")


def subset_cv_rmse(df: DataFrame, target: str, features: Sequence[str], fold: str = "fold", model: str = "gbt",
                   **params) -> float:
    """Mean CV RMSE of a model trained on a feature subset."""
    from plinth.operators.models import assemble, cv_rmse, make_tree

    data = assemble(df, features).select("features", col(target).alias("label"), col(fold)).persist()
    mean, _ = cv_rmse(data, lambda: make_tree(model, **params), fold)
    data.unpersist()
    return mean


def best_feature_count(df: DataFrame, target: str, ranked: Sequence[str], counts: Sequence[int],
                       fold: str = "fold", model: str = "gbt", **params) -> tuple[int, float]:
    """Sweep the top-N sizes, keep the least CV RMSE (the full set is the initial best).
    The assembled table is cached once; each size is a ``VectorSlicer`` over it."""
    from pyspark.ml.feature import VectorSlicer

    from plinth.operators.models import assemble, cv_rmse, make_tree

    data = assemble(df, ranked).select("features", col(target).alias("label"), col(fold)).persist()
    best_n = len(ranked)
    best, _ = cv_rmse(data, lambda: make_tree(model, **params), fold)
    for n in sorted(set(counts)):
        if n >= len(ranked):
            continue
        sliced = VectorSlicer(inputCol="features", outputCol="_f", indices=list(range(n))).transform(data) \
            .drop("features").withColumnRenamed("_f", "features")
        score, _ = cv_rmse(sliced, lambda: make_tree(model, **params), fold)
        if score < best:
            best, best_n = score, n
    data.unpersist()
    return best_n, best


def select_features(df: DataFrame, target: str, features: Sequence[str], categorical: Sequence[str] = (),
                    method: str = "auto", percentile: float = 10.0, n_features: int | None = None,
                    weights: Mapping[str, float] | None = None, fold: str = "fold",
                    redundancy: float = 0.95, score_methods: Sequence[str] = ("correlation", "gbt", "lasso"),
                    sweep: Sequence[int] = ()) -> DataFrame:
    """Score, combine, drop redundant, then select by percentile / count / optimal
    count ('auto' = percentile).  Categorical columns are always kept.  Returns the
    selected feature names with their combined score."""
    parts = []
    if "correlation" in score_methods:
        parts.append(correlation_importance(df, target, features))
    for m in ("gbt", "rf"):
        if m in score_methods:
            parts.append(tree_importance(df, target, features, fold, m))
    if "lasso" in score_methods:
        parts.append(lasso_importance(df, target, features, fold))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    w = dict(weights or {"correlation": 1.0, "gbt": 2.0, "rf": 2.0, "lasso": 1.5})
    combined = combine_scores(scores, w)
    _, removed = remove_redundant(combined, correlation_pairs(df, features, redundancy))
    removed_set = {r[0] for r in removed.collect()}  # at most the number of features
    combined = combined.withColumn("combined", F.when(F.col("feature").isin(*removed_set), F.lit(0.0))
                                   .otherwise(F.col("combined"))) if removed_set else combined
    if method in ("auto", "percentile"):
        chosen = select_by_percentile(combined, percentile)
    elif method == "count":
        chosen = select_top_n(combined, n_features or len(features))
    elif method == "optimal":
        ranked = [r[0] for r in combined.orderBy(F.desc("combined"), "feature").collect()]
        n, _ = best_feature_count(df, target, ranked, list(sweep) or [max(1, len(ranked) // 2)], fold)
        chosen = select_top_n(combined, n)
    else:
        raise ValueError(f"unknown selection method {method!r}")
    if categorical:
        cats = df.sparkSession.createDataFrame([(c, 0.001) for c in categorical], "feature string, combined double")
        chosen = chosen.unionByName(cats.join(chosen.select("feature"), "feature", "left_anti"))
    return chosen
