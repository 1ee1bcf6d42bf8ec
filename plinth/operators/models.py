"""Regression models with k-fold CV on a ``fold`` column: J01-J09 (MLlib).

All models train on the log target and predict through ``expm1``.  sklearn's
regularisation strengths are mapped onto MLlib's parameterisation:

* ridge ``alpha``       -> ``regParam = alpha / n * std_pop(y)``, ``elasticNetParam = 0``
* lasso ``alpha``       -> ``regParam = alpha``, ``elasticNetParam = 1``
* elastic net (a, l1)   -> ``A1 = a*l1``, ``A2 = a*(1-l1)*std_pop(y)``,
  ``regParam = A1 + A2``, ``elasticNetParam = A1 / (A1 + A2)``

always with ``standardization=False`` (features are scaled upstream).
"""

from __future__ import annotations

import functools
import inspect
import itertools
import operator
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.sizing import hold
from plinth.operators.features import col


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature columns -> one vector column (JVM-side, no Python per row)."""
    cast = df.select(*[c for c in df.columns if c not in features],
                     *[col(f).cast("double").alias(f) for f in features])
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(cast)


def label_stats(train: DataFrame, label: str = "label") -> tuple[int, float]:
    r = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["s"] or 0.0)


def fit_linear(kind: str, alpha: float = 0.0, l1_ratio: float = 0.5, n: int | None = None,
               y_std: float | None = None, max_iter: int = 200):
    """A ``LinearRegression`` matching sklearn's objective for ``kind`` in
    ols / ridge / lasso / elasticnet (``n`` and ``y_std`` of the training rows are
    needed for the L2 parts)."""
    from pyspark.ml.regression import LinearRegression

    if kind == "ols":
        reg, enp = 0.0, 0.0
    elif kind == "ridge":
        reg, enp = alpha / max(1, n or 1) * (y_std or 0.0), 0.0
    elif kind == "lasso":
        reg, enp = alpha, 1.0
    elif kind == "elasticnet":
        a1, a2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * (y_std or 0.0)
        reg = a1 + a2
        enp = a1 / reg if reg > 0 else 0.0
    else:
        raise ValueError(f"unknown linear model {kind!r}")
    solver = "normal" if enp == 0.0 else "auto"
    return LinearRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=enp,
                            standardization=False, solver=solver, maxIter=max_iter)


def make_tree(kind: str = "gbt", seed: int = 42, **params):
    """``rf`` = RandomForestRegressor; ``gbt`` = GBTRegressor (``lossType`` squared or
    absolute).  One operator for the reference's three boosting libraries."""
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    if kind == "rf":
        return RandomForestRegressor(featuresCol="features", labelCol="label", seed=seed, **params)
    if kind == "gbt":
        return GBTRegressor(featuresCol="features", labelCol="label", seed=seed, **params)
    raise ValueError(f"unknown tree model {kind!r}")


def _estimator(factory: Callable, train: DataFrame):
    """``factory(train)`` where it has a parameter without a default, else ``factory()``."""
    needed = [p for p in inspect.signature(factory).parameters.values() if p.default is p.empty and p.kind not in (p.VAR_POSITIONAL, p.VAR_KEYWORD)]
    return factory(train) if needed else factory()


#: Fits of a cross-validation that run at a time.
FIT_THREADS = 4


#: Rows of a partition that the tasks of a fit read.
FIT_ROWS, LEAST_FIT_ROWS = 50_000, 1_000


def is_cached(df: DataFrame) -> bool:
    return df.storageLevel != StorageLevel.NONE


def even_cache(df: DataFrame) -> DataFrame:
    """``df`` cached in even partitions, as many as its rows fill or, if these are fewer, as the session has cores.

    A fit runs some twenty jobs over its rows, and a job starts a task a partition: a table that comes out of a shuffle by few
    keys has mostly empty ones, which cost more than the rows.  The caller releases the result."""
    first = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = first.count()
        parts = max(1, -(-n // FIT_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_FIT_ROWS)))
        even = first.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        even.count()
    finally:
        first.unpersist()
    return even


def fit_folds(data: DataFrame, factories: Mapping[str, Callable], fold: str = "fold") -> dict[tuple, object]:
    """The fitted model of every (name, fold ``k``), on the rows with ``fold != k``.  ``data`` should be cached: every fit reads
    it several times.  The fits are independent and run from a small pool of driver threads."""
    folds = [r[0] for r in data.select(fold).distinct().orderBy(fold).collect()]  # k values

    def fit(unit):
        name, k = unit
        train = data.where(col(fold) != k)
        return _estimator(factories[name], train).fit(train)

    units = [(name, k) for name in factories for k in folds]
    with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
        return dict(zip(units, pool.map(inheritable_thread_target(data.sparkSession)(fit), units)))


def cv_predictions(data: DataFrame, factory: Callable, fold: str = "fold", key: str | None = None) -> DataFrame:
    """Out-of-fold predictions: for each fold ``k`` fit on ``fold != k`` and predict ``fold == k``.

    ``factory(train)`` (or ``factory()``) returns an unfitted estimator.  One fit
    per fold; the union of the validation parts is the OOF table.  Fits and predictions read ``data`` from a cache.
    """
    data = data if is_cached(data) else hold(data)
    parts = [m.transform(data.where(col(fold) == k)) for (_, k), m in fit_folds(data, {"": factory}, fold).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_rmse(pred: DataFrame, fold: str = "fold", label: str = "label", prediction: str = "prediction",
              real_space: bool = False, clip: tuple[float, float] | None = None) -> DataFrame:
    """RMSE per fold (optionally after clipping log predictions and ``expm1``), one aggregate."""
    p = col(prediction)
    if clip:
        p = F.least(F.greatest(p, F.lit(clip[0])), F.lit(clip[1]))
    y = col(label)
    if real_space:
        p, y = F.expm1(p), F.expm1(y)
    d = y - p
    return pred.groupBy(col(fold)).agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def cv_fold_rmse(data: DataFrame, factory: Callable, k, fold: str = "fold", **kw) -> float:
    """RMSE on fold ``k`` of a fit on the others; infinite where no row could be scored."""
    train = data.where(col(fold) != k)
    pred = _estimator(factory, train).fit(train).transform(data.where(col(fold) == k))
    got = fold_rmse(pred, fold, **kw).first()
    return float("inf") if got is None or got["rmse"] is None else float(got["rmse"])


def cv_rmse(data: DataFrame, factory: Callable, fold: str = "fold", **kw) -> tuple[float, float]:
    """Mean and (population) std of the per-fold RMSE."""
    kept = not is_cached(data)
    if kept:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        per = fold_rmse(cv_predictions(data, factory, fold), fold, **kw)
        r = per.agg(F.avg("rmse").alias("m"), F.stddev_pop("rmse").alias("s")).first()
    finally:
        if kept:
            data.unpersist()
    return float(r["m"]), float(r["s"] or 0.0)


def linear_factory(kind: str, alpha: float = 0.0, l1_ratio: float = 0.5):
    def make(train: DataFrame):
        n, s = label_stats(train)
        return fit_linear(kind, alpha, l1_ratio, n, s)
    return make


def ridge_closed_form(df: DataFrame, features: Sequence[str], label: str, alpha: float):
    """J01 reference solution ``(X'X + alpha I)^-1 X'y`` with an unpenalised intercept, from
    the moments of all rows -- used to verify the MLlib mapping."""
    moments = fold_moments(df.withColumn("_all", F.lit(0)), features, label, "_all")[0]
    return solve_linear(*moments, "ridge", alpha)


#: Numbers of one row of partial cross products; a longer row of the matrix is cut into several.
GRAM_WIDTH = 64
#: Rows of one Arrow batch, so that a batch of ``p`` doubles a row stays small.
GRAM_BATCH = 2048


class Moments(NamedTuple):
    """``n``, sums and cross products of ``[features, label]`` less ``shift``."""

    n: int
    s: np.ndarray
    g: np.ndarray
    shift: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.s - other.s, self.g - other.g, self.shift)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.s + other.s, self.g + other.g, self.shift)


def _matrix_rows(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """(f, v): fold and ``[features, label]`` as one array; a missing feature counts as 0, rows without label are left out."""
    xs = [F.coalesce(F.nanvl(col(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in features]
    y = col(label).cast("double")
    return df.where(y.isNotNull() & ~F.isnan(y) & col(fold).isNotNull()).select(
        col(fold).cast("long").alias("f"), F.array(*xs, y).alias("v"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(fold, matrix of its rows) for pieces of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, GRAM_BATCH):
            part = batch.slice(at, GRAM_BATCH)
            folds = part.column(0).to_numpy(zero_copy_only=False)
            m = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(folds), -1)
            for k in np.unique(folds):
                yield int(k), m[folds == k]


def fold_moments(df: DataFrame, features: Sequence[str], label: str = "label", fold: str = "fold") -> dict[int, Moments]:
    """Per fold the moments of ``[features, label]``: all that a linear fit needs, in one pass.

    Tasks multiply blocks of rows less a first estimate of the means (of a few rows), so columns of large mean and
    small spread lose no digits.  Partial matrices travel as rows of at most ``GRAM_WIDTH`` numbers, which Spark
    adds up: the plan has the same size for 5 and for 5,000 features.  The driver receives p x p numbers a fold.
    A missing feature counts as 0; rows without label or fold are left out.
    """
    p = len(features) + 1
    rows = _matrix_rows(df, features, label, fold)
    few = [r["v"] for r in rows.limit(100).collect()]
    shift = np.mean(few, axis=0) if few else np.zeros(p)
    pieces = -(-p // GRAM_WIDTH)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for k, m in _blocks(batches):
            d = m - shift
            t = total.setdefault(k, [0, np.zeros(p), np.zeros((p, p))])
            t[0] += len(d)
            t[1] += d.sum(axis=0)
            t[2] += d.T @ d
        for k, (n, s, g) in total.items():
            table = np.zeros((p + 1, pieces * GRAM_WIDTH))  # the sums are the last row
            table[:p, :p], table[p, :p] = g, s
            table = table.reshape(-1, GRAM_WIDTH)
            ids = np.arange(len(table))
            columns = [pa.array(np.full(len(ids), k)), pa.array(ids // pieces), pa.array(ids % pieces), pa.array(np.full(len(ids), n))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(table[:, j]) for j in range(GRAM_WIDTH)],
                                             ["f", "i", "piece", "n"] + [f"c{j}" for j in range(GRAM_WIDTH)])

    schema = "f long, i long, piece long, n long, " + ", ".join(f"c{j} double" for j in range(GRAM_WIDTH))
    sums = rows.mapInArrow(partial, schema).groupBy("f", "i", "piece").agg(F.sum("n").alias("n"), *[F.sum(f"c{j}").alias(f"c{j}") for j in range(GRAM_WIDTH)])
    tables: dict[int, np.ndarray] = {}
    counts: dict[int, int] = {}
    for r in sums.collect():
        table = tables.setdefault(r["f"], np.zeros((p + 1, pieces * GRAM_WIDTH)))
        table[r["i"], r["piece"] * GRAM_WIDTH : (r["piece"] + 1) * GRAM_WIDTH] = r[4:]
        counts[r["f"]] = r["n"]
    return {k: Moments(counts[k], t[p, :p], t[:p, :p], shift) for k, t in sorted(tables.items())}


def _sparse_weights(a: np.ndarray, b: np.ndarray, l1: float, l2: float, var_y: float, w: np.ndarray, tol: float) -> np.ndarray:
    """Weights that minimise ``w'aw/2 - b'w + l1 |w| + l2 w'w/2``, from the start ``w``, by feature-sign search.

    With the signs given, the optimum of the features in use is a linear solve.  A step goes towards it, up to the
    change of sign (that feature leaves) at which the objective is least; where the features in use are optimal, the
    one that breaks its condition most enters.  Each step lowers the objective, so no set of signs comes twice and
    the search ends, also with collinear features, where coordinate descent takes very many sweeps.  Conditions hold
    to ``tol`` of the label's spread, on features of unit variance, so scales make no difference."""
    scale = np.sqrt(np.maximum(np.diag(a), 0.0))
    used = np.flatnonzero(scale > 0)
    out = np.zeros(len(b))
    if not used.size or var_y <= 0:
        return out
    unit = scale[used]
    a, b, first, second = a[np.ix_(used, used)] / np.outer(unit, unit), b[used] / unit, l1 / unit, l2 / unit**2
    a = a + np.diag(second)
    if l1 == 0:
        out[used] = np.linalg.lstsq(a, b, rcond=None)[0] / unit
        return out

    def objective(rows: np.ndarray) -> np.ndarray:
        return ((rows @ a) * rows).sum(axis=1) / 2 - rows @ b + np.abs(rows) @ first

    v, slack = w[used] * unit, tol * np.sqrt(var_y)
    least = objective(v[None])[0]
    while True:
        sign, rest = np.sign(v), b - a @ v
        if (np.abs(rest - first * sign)[v != 0] <= slack).all():
            over = np.where(v == 0, np.abs(rest) - first, -np.inf)
            enters = int(over.argmax())
            if over[enters] <= slack:
                break
            sign[enters] = np.sign(rest[enters])
        on = np.flatnonzero(sign)
        goal = np.zeros(len(v))
        goal[on] = np.linalg.lstsq(a[np.ix_(on, on)], b[on] - (first * sign)[on], rcond=None)[0]
        leaves = np.flatnonzero(v * goal < 0)
        share = np.append(v[leaves] / (v[leaves] - goal[leaves]), 1.0)
        points = v + share[:, None] * (goal - v)
        points[np.arange(leaves.size), leaves] = 0.0
        found = objective(points)
        best = int(found.argmin())
        if not found[best] < least:  # nothing left but rounding
            break
        v, least = points[best], found[best]
    out[used] = v / unit
    return out


def solve_linear(n: int, s, g, shift, kind: str, alpha: float, l1_ratio: float = 0.5, tol: float = 1e-9, start=None):
    """(weights, intercept) from the :class:`Moments` of the training rows, with sklearn's objectives.

    ols and ridge are linear solves; lasso and elastic net are solved on the p x p moments,
    from the weights ``start`` if given.
    """
    mean = s / n
    cov = g / n - np.outer(mean, mean)
    mean = mean + shift
    a, b = cov[:-1, :-1], cov[:-1, -1]
    if kind in ("ols", "ridge"):
        w = np.linalg.lstsq(a + (alpha if kind == "ridge" else 0.0) / n * np.eye(len(b)), b, rcond=None)[0]
    elif kind in ("lasso", "elasticnet"):
        l1 = alpha * (1.0 if kind == "lasso" else l1_ratio)
        l2 = 0.0 if kind == "lasso" else alpha * (1 - l1_ratio)
        w = _sparse_weights(a, b, l1, l2, cov[-1, -1], np.zeros(len(b)) if start is None else np.array(start), tol)
    else:
        raise ValueError(f"unknown linear model {kind!r}")
    return w, float(mean[-1] - w @ mean[:-1])


def linear_grid(df: DataFrame, features: Sequence[str], grid: Sequence[Mapping], label: str = "label", fold: str = "fold",
                real_space: bool = False, moments: dict[int, Moments] | None = None) -> list[tuple[Mapping, float, float]]:
    """Every point of a linear grid (``kind``, ``alpha``, ``l1``) by mean CV RMSE, in two passes.

    One pass gives each fold's moments; a point's fit on the other folds is a small solve.  One more pass scores
    all points on their validation rows as products of row blocks and weights (with ``expm1`` in ``real_space``);
    a task sends one row a fold and point.  ``moments``: those of :func:`fold_moments`, if known.
    """
    moments = moments or fold_moments(df, features, label, fold)
    whole = functools.reduce(operator.add, moments.values())
    weights, intercepts = {}, {}
    for k, m in moments.items():
        fits, near = [], None
        for p in grid:  # the point before is close to this one's optimum
            fits.append(solve_linear(*(whole - m), p["kind"], p["alpha"], p.get("l1", 0.5), start=near))
            near = fits[-1][0]
        weights[k], intercepts[k] = np.array([w for w, _ in fits]).T, np.array([c for _, c in fits])

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for k, m in _blocks(batches):
            pred, y = m[:, :-1] @ weights[k] + intercepts[k], m[:, -1:]
            d = np.expm1(y) - np.expm1(pred) if real_space else y - pred
            t = total.setdefault(k, [0, np.zeros(len(grid))])
            t[0] += len(d)
            t[1] += (d * d).sum(axis=0)
        for k, (n, e) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), x)) for x in (k, n)] + [pa.array(np.arange(len(e))), pa.array(e)],
                                             ["f", "n", "point", "e"])

    rows = _matrix_rows(df, features, label, fold).mapInArrow(errors, "f long, n long, point long, e double")
    rmse = rows.groupBy("f", "point").agg(F.sqrt(F.sum("e") / F.sum("n")).alias("rmse")).collect()  # folds x grid
    table: list[list[float]] = [[] for _ in grid]
    for r in sorted(rmse, key=lambda r: (r["f"], r["point"])):
        table[r["point"]].append(r["rmse"])
    return sorted(((p, float(np.mean(e)), float(np.std(e))) for p, e in zip(grid, table)), key=lambda r: r[1])


def grid_search(data: DataFrame, grid: Sequence[Mapping], factory_for: Callable[[Mapping], Callable],
                fold: str = "fold", threads: int = 4, **kw) -> list[tuple[Mapping, float, float]]:
    """J03-J05/J08 grid: every parameter set scored by mean CV RMSE; independent fits run
    concurrently from a driver thread pool over the one cached table."""
    data = data.persist()

    def score(params):
        m, s = cv_rmse(data, factory_for(params), fold, **kw)
        return params, m, s

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        results = list(pool.map(score, grid))
    data.unpersist()
    return sorted(results, key=lambda r: r[1])


def sample_space(space: Mapping[str, object], trials: int, seed: int = 42) -> list[dict]:
    """Typed search space -> parameter sets.  A list is categorical; ``(lo, hi)`` ints are
    integer ranges; ``(lo, hi)`` floats uniform; ``(lo, hi, "log")`` log-uniform.  When the
    space is all-categorical and small, the full grid is returned instead."""
    rng = random.Random(seed)
    if all(isinstance(v, list) for v in space.values()):
        full = [dict(zip(space, combo)) for combo in itertools.product(*space.values())]
        if len(full) <= trials:
            return full
    out = []
    for _ in range(trials):
        p = {}
        for k, v in space.items():
            if isinstance(v, list):
                p[k] = rng.choice(v)
            elif isinstance(v, tuple) and len(v) == 3 and v[2] == "log":
                import math
                p[k] = math.exp(rng.uniform(math.log(v[0]), math.log(v[1])))
            elif isinstance(v, tuple) and all(isinstance(x, int) for x in v[:2]):
                p[k] = rng.randint(v[0], v[1])
            elif isinstance(v, tuple):
                p[k] = rng.uniform(v[0], v[1])
            else:
                p[k] = v
        out.append(p)
    return out


def save_model(model, path: str) -> None:
    """Persist a fitted MLlib model (overwrite)."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """Load a fitted model of class ``cls`` (e.g. ``LinearRegressionModel``)."""
    return cls.load(path)
