"""Ensembles: blending and stacking over prediction tables.

Predictions are long ``(key, model, pred)`` or wide ``(key, pred_<model>...)``
tables joined on the key.  Blend weights are solved from ONE Gram aggregate
(``P'P``, ``P'y``, ``y'y``; k x k for k models) on the driver.
"""

from __future__ import annotations

import hashlib

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.sizing import broadcast_if_small, hold
from plinth.operators.features import bounded_inverse, col


class AlignmentError(ValueError):
    pass


def align_predictions(frames: Mapping[str, DataFrame], key: str, pred: str = "pred",
                      strict: bool = True) -> DataFrame:
    """Every model's predictions side by side, one shuffle on ``key`` however many models; a key missing from
    any model is an error (``strict``) or left NULL."""
    long = _union([f.select(col(key), F.lit(name).alias("_model"), col(pred).alias("_p")) for name, f in frames.items()])
    # two predictions of a model for a key are an error, not a choice
    one = F.when(F.count(F.lit(1)) <= 1, F.first("_p")).otherwise(
        F.raise_error(F.lit("more than one prediction for a key and model")).cast("double"))
    out = long.groupBy(col(key)).pivot("_model", list(frames)).agg(one)
    if strict:
        miss = out.agg(*[F.sum(F.when(col(n).isNull(), 1).otherwise(0)).alias(n) for n in frames]).first().asDict()
        bad = {k: v for k, v in miss.items() if v}
        if bad:
            raise AlignmentError(f"prediction ids do not align: missing per model {bad}")
    return out


def active_models(weights: DataFrame) -> DataFrame:
    """Models with a positive weight (``model, weight``)."""
    return weights.where(F.col("weight") > 0)


def blend(long_preds: DataFrame, weights: DataFrame, key: str, log_space: bool = True,
          bounds: bool = True) -> DataFrame:
    """Weighted blend per key, weights normalised to sum 1 over the active models.

    ``log_space``: average log predictions then ``expm1`` (clipped like the reference);
    otherwise average ``expm1`` of each prediction.
    """
    w = broadcast_if_small(active_models(weights))
    j = long_preds.join(w, "model")
    val = F.col("pred") if log_space else F.expm1("pred")
    agg = j.groupBy(col(key)).agg((F.sum(F.col("weight") * val) / F.sum("weight")).alias("_b"))
    if log_space:
        out = bounded_inverse(F.col("_b")) if bounds else F.expm1("_b")
    else:
        out = F.col("_b")
    return agg.select(col(key), out.alias("blend"))


def gram(wide: DataFrame, models: Sequence[str], y: str) -> tuple[np.ndarray, np.ndarray, float, int]:
    """``P'P``, ``P'y``, ``y'y`` and n in one aggregate (k(k+1)/2 + k + 2 sums)."""
    k = len(models)
    aggs = [F.sum(col(models[i]) * col(models[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    aggs += [F.sum(col(m) * col(y)).alias(f"b{i}") for i, m in enumerate(models)]
    aggs += [F.sum(col(y) * col(y)).alias("yy"), F.count(F.lit(1)).alias("n")]
    r = wide.agg(*aggs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = r[f"g{i}_{j}"]
    b = np.array([r[f"b{i}"] for i in range(k)], dtype=float)
    return g, b, float(r["yy"]), int(r["n"])


def project_simplex(v: np.ndarray) -> np.ndarray:
    """Euclidean projection onto ``{w >= 0, sum w = 1}``."""
    u = np.sort(v)[::-1]
    css = np.cumsum(u)
    rho = np.nonzero(u * np.arange(1, len(v) + 1) > (css - 1))[0][-1]
    theta = (css[rho] - 1) / (rho + 1.0)
    return np.maximum(v - theta, 0.0)


def optimize_weights(wide: DataFrame, models: Sequence[str], y: str) -> dict[str, float]:
    """Weights on the simplex minimising the blend RMSE.

    The objective ``(w'Gw - 2 w'b + yy) / n`` needs only the Gram aggregate; what is left is a k x k
    quadratic program, solved exactly by an active set on the driver.
    """
    g, b, _, _ = gram(wide, models, y)
    w = simplex_qp(g, b)
    return {m: float(w[i]) for i, m in enumerate(models)}


def simplex_qp(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``argmin w'Gw/2 - w'b`` over ``{w >= 0, sum w = 1}``, by a primal active-set method.

    Starts at the best single model and moves between faces of the simplex; the objective falls with
    every face, so it ends.  Raises if rounding keeps it from ending.
    """
    k = len(b)
    start = int(np.argmin(np.diag(g) / 2 - b))
    w, free = np.eye(k)[start], [start]
    scale = max(np.abs(g).max(), np.abs(b).max(), 1e-300)
    for _ in range(50 * k + 50):
        m = len(free)
        kkt = np.zeros((m + 1, m + 1))
        kkt[:m, :m], kkt[:m, m], kkt[m, :m] = g[np.ix_(free, free)] / scale, 1.0, 1.0
        goal = np.linalg.lstsq(kkt, np.append(b[free] / scale, 1.0), rcond=None)[0][:m]
        step = goal - w[free]
        falling = step < -1e-15
        ratio = np.min(np.where(falling, -w[free] / np.where(falling, step, -1.0), np.inf), initial=np.inf)
        if ratio < 1:  # a weight reaches zero first: leave its face
            w[free] += ratio * step
            gone = free[int(np.argmin(np.where(falling, w[free], np.inf)))]
            w[gone] = 0.0
            free.remove(gone)
            continue
        w[free] = goal
        grad = (g @ w - b) / scale
        level = grad[free].mean()
        out = [i for i in range(k) if i not in free]
        best = min(out, key=lambda i: grad[i], default=None)
        if best is None or grad[best] >= level - 1e-12:
            return np.maximum(w, 0.0) / np.maximum(w, 0.0).sum()
        free.append(best)
    raise RuntimeError("blend weights did not converge")


def blend_rmse(wide: DataFrame, models: Sequence[str], y: str, weights: Mapping[str, float]) -> float:
    g, b, yy, n = gram(wide, models, y)
    w = np.array([weights[m] for m in models])
    return float(np.sqrt(max(0.0, (w @ g @ w - 2 * w @ b + yy) / n)))


def oof_predictions(data: DataFrame, factories: Mapping[str, object], key: str, fold: str = "fold",
                    test: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Out-of-fold predictions of every base model (wide, ``pred_<model>``) and, for the
    test rows, the mean of the k fold models' predictions."""
    from plinth.operators.models import fit_folds, is_cached

    names = list(factories)
    data = data if is_cached(data) else hold(data)
    models = fit_folds(data, factories, fold)
    folds = list(dict.fromkeys(k for _, k in models))

    def beside(df: DataFrame, units: Sequence[tuple]) -> DataFrame:
        """The predictions of some models as columns ``_p0``, ``_p1``, ...: no row is copied."""
        for i, u in enumerate(units):
            df = models[u].transform(df).withColumnRenamed("prediction", f"_p{i}")
        return df

    # rows keep their place: one shuffle of the finished rows makes one row of repeated keys
    parts = [beside(data.where(col(fold) == k), [(n, k) for n in names])
             .select(col(key), *[F.col(f"_p{i}").alias(f"pred_{n}") for i, n in enumerate(names)]) for k in folds]
    oof = _union(parts).groupBy(col(key)).agg(*[F.first(col(f"pred_{n}")).alias(f"pred_{n}") for n in names])
    tst = None
    if test is not None:
        units = [(n, k) for n in names for k in folds]
        mean = [sum(F.col(f"_p{units.index((n, k))}") for k in folds) / len(folds) for n in names]
        wide = beside(test, units).select(col(key), *[m.alias(f"_m{i}") for i, m in enumerate(mean)])
        tst = wide.groupBy(col(key)).agg(*[F.avg(f"_m{i}").alias(f"pred_{n}") for i, n in enumerate(names)])
    return oof, tst


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def input_fingerprint(df: DataFrame, *settings: str) -> str:
    """A digest of a table's rows (in any order) and of the settings used on it, in one aggregate."""
    names = sorted(df.columns)
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[col(c) for c in names]).cast("decimal(38,0)")),
                 F.sum(F.hash(*[col(c) for c in names]).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((names, df.dtypes, tuple(map(str, row)), settings)).encode()).hexdigest()[:32]


def cached_oof(spark, path: str, fingerprint: str, compute) -> DataFrame:
    """Reuse an OOF table written under ``path/<fingerprint>``; otherwise compute and write it.

    The fingerprint must cover the input rows (:func:`input_fingerprint`), so a changed input never
    reads a stale cache.  Only a folder without a finished table counts as missing."""
    target = f"{path.rstrip('/')}/{fingerprint}"
    try:
        return spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        df = compute()
        df.write.mode("overwrite").parquet(target)
        return spark.read.parquet(target)


def stack_meta(oof: DataFrame, test_preds: DataFrame, models: Sequence[str], y: str, key: str,
               alpha: float = 0.1) -> tuple[object, DataFrame]:
    """Ridge meta-model on the OOF columns; test predictions clipped and ``expm1``'d."""
    from plinth.operators.models import assemble, fit_linear, label_stats

    cols = [f"pred_{m}" for m in models]
    train = assemble(oof, cols).withColumn("label", col(y))
    n, s = label_stats(train)
    meta = fit_linear("ridge", alpha, n=n, y_std=s).fit(train)
    pred = meta.transform(assemble(test_preds, cols))
    return meta, pred.select(col(key), bounded_inverse(F.col("prediction")).alias("SalePrice"))


def choose_blend_source(oof_test: DataFrame, tables: DataFrame, key: str, models: Sequence[str]) -> DataFrame:
    """Use OOF test predictions when EVERY active model has them for every key, else the
    prediction tables.  Both inputs are long ``(key, model, pred)``."""
    avail = oof_test.where(F.col("model").isin(*models)).groupBy("model").agg(F.count("pred").alias("n"))
    need = tables.where(F.col("model").isin(*models)).groupBy("model").agg(F.count("pred").alias("m"))
    chk = need.join(avail, "model", "left").agg(
        F.bool_and(F.coalesce(F.col("n"), F.lit(0)) >= F.col("m")).alias("ok"),
        F.count(F.lit(1)).alias("k")).first()
    use_oof = bool(chk["ok"]) and chk["k"] == len(models)
    src = oof_test if use_oof else tables
    return src.where(F.col("model").isin(*models)).withColumn("source", F.lit("oof" if use_oof else "tables"))
