"""Distribution-shape transforms and reports (stage 3): B05, B06, C02-C05.

Power-transform parameters are fitted by maximum likelihood without sorting or
collecting rows: one pass gives the log-likelihood of a grid of lambdas of ALL
columns (tasks transform blocks of values and send mean and squared deviations
per lambda), and each column's grid is refined around its best point a few times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.quantile import group_quantiles
from plinth.functions.sizing import broadcast_if_small
from plinth.operators.features import col, with_columns


# ---------------------------------------------------------------- transforms
def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson transform with a fixed lambda."""
    x = x.cast("double")
    pos = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    neg = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def box_cox(x: Column, lam: float) -> Column:
    """Box-Cox transform (x > 0) with a fixed lambda."""
    x = x.cast("double")
    return F.log(x) if abs(lam) < 1e-12 else (F.pow(x, F.lit(lam)) - 1) / lam


#: Widest range of lambdas that is searched; beyond it powers overflow.
MAX_BRACKET = 320.0


def _power(kind: str, x: Column, lam: Column) -> Column:
    """The transform with a lambda that is itself a column, and so may differ by row."""
    if kind == "box-cox":
        return F.when(F.abs(lam) < 1e-12, F.log(x)).otherwise((F.pow(x, lam) - 1) / lam)
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    neg = F.when(F.abs(lam - 2) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(1 - x, 2 - lam) - 1) / (2 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, x): a row per value that is not missing, ``c`` the column's position.  Only ever aggregated by ``c``, so
    it is combined before the shuffle to one row a column and task."""
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), col(c).cast("double").alias("x")) for i, c in enumerate(cols)])
    return df.select(F.inline(pairs)).where(F.col("x").isNotNull() & ~F.isnan("x"))


def _by_column(values: Sequence[float]) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("c") + 1)


def _peak(lams: Sequence[float], scores: Sequence[float]) -> float:
    """Summit of the parabola through the best of equally spaced points and its two neighbours."""
    i = max(range(len(lams)), key=scores.__getitem__)
    if 0 < i < len(lams) - 1 and all(map(math.isfinite, scores[i - 1 : i + 2])):
        before, best, after = scores[i - 1 : i + 2]
        bend = before - 2 * best + after
        if bend < 0:
            return lams[i] + (lams[1] - lams[0]) * (before - after) / bend / 2
    return lams[i]


#: Rows that a task transforms by all lambdas of a round at a time.
BLOCK_ROWS = 4096


class Spread(NamedTuple):
    """Number, sum of the slope's terms, least and largest value, and mean and squared deviations of each lambda's transforms."""

    n: int
    slope: float
    low: float
    high: float
    mean: np.ndarray
    m2: np.ndarray

    def __add__(self, other: Spread) -> Spread:
        n, gap = self.n + other.n, other.mean - self.mean
        return Spread(n, self.slope + other.slope, min(self.low, other.low), max(self.high, other.high), self.mean + gap * (other.n / n),
                      self.m2 + other.m2 + gap * gap * (self.n / n * other.n))


def _spread(x: np.ndarray, lams: np.ndarray, kind: str) -> Spread | None:
    """The spread of a block of values; missing ones, and for Box-Cox those that are not positive, are left out."""
    x = x[x > 0] if kind == "box-cox" else x[~np.isnan(x)]
    if not x.size:
        return None
    size = np.log(x) if kind == "box-cox" else np.log1p(np.abs(x))
    sign = np.ones(len(x)) if kind == "box-cox" else np.where(x >= 0, 1.0, -1.0)
    t = np.empty((len(lams), len(x)))
    for side, powers in ((sign > 0, lams), (sign < 0, 2 - lams)):
        if side.any():
            p, u = np.where(np.abs(powers) < 1e-12, 1.0, powers)[:, None], size[side]
            t[:, side] = np.where(np.abs(powers)[:, None] < 1e-12, u, np.expm1(p * u) / p)
    t *= sign
    mean = t.mean(axis=1)
    return Spread(len(x), float((sign * size).sum()), float(x.min()), float(x.max()), mean, ((t - mean[:, None]) ** 2).sum(axis=1))


def _spreads(data: DataFrame, places: Sequence[int], lams: np.ndarray, kind: str) -> dict[int, Spread]:
    """The :class:`Spread` of each column of ``places`` under its row of ``lams``, in one pass.  A task sends one row a
    column; blocks and tasks are merged pairwise, so large means cost no digits."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, Spread] = {}
        with np.errstate(all="ignore"):  # a power that overflows has no finite likelihood
            for batch in batches:
                for i, c in enumerate(places):
                    x = batch.column(c).to_numpy(zero_copy_only=False)
                    for at in range(0, len(x), BLOCK_ROWS):
                        s = _spread(x[at : at + BLOCK_ROWS].astype(np.float64), lams[i], kind)
                        if s is not None:
                            total[i] = total[i] + s if i in total else s
        rows = [(i, s.n, s.slope, s.low, s.high, s.mean.tolist(), s.m2.tolist()) for i, s in total.items()]
        kinds = [pa.int32(), pa.int64(), *[pa.float64()] * 3, *[pa.list_(pa.float64())] * 2]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)],
                                         ["i", "n", "slope", "low", "high", "mean", "m2"])

    out: dict[int, Spread] = {}
    with np.errstate(all="ignore"):
        for r in data.mapInArrow(add, "i int, n long, slope double, low double, high double, mean array<double>, m2 array<double>").collect():
            s = Spread(r["n"], r["slope"], r["low"], r["high"], np.array(r["mean"]), np.array(r["m2"]))
            out[r["i"]] = out[r["i"]] + s if r["i"] in out else s
    return out


def fit_lambdas(df: DataFrame, cols: Sequence[str], kind: str = "yeo-johnson", lo: float = -5.0, hi: float = 5.0,
                points: int = 25, rounds: int = 3) -> dict[str, float | None]:
    """Maximum-likelihood lambda of every column; None where no lambda has a finite likelihood.

    All columns and all lambdas of a round share one pass over the cached values, so the number of jobs does not grow with the
    columns: each column has its own range, which a round narrows to the two steps around its best point, or
    widens where that lies on the border.  The last round's best three points give the summit.  Missing values, and
    for Box-Cox values that are not positive, are left out of the likelihood.
    """
    if not cols:
        return {}
    ranges = {c: (lo, hi) for c in cols}
    left = dict.fromkeys(cols, rounds)
    out: dict[str, float | None] = {}
    data = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while len(out) < len(cols):
            todo = [c for c in cols if c not in out]
            grids = [[ranges[c][0] + (ranges[c][1] - ranges[c][0]) / (points - 1) * j for j in range(points)] for c in todo]
            found = _spreads(data, [cols.index(c) for c in todo], np.array(grids), kind)
            for i, c in enumerate(todo):
                (low, high), grid = ranges[c], grids[i]
                scores = [-math.inf] * points
                if i in found and found[i].low < found[i].high:  # the variance of equal values may be a rounding error above 0
                    slope = found[i].slope / found[i].n
                    scores = [-math.log(v) / 2 + (lam - 1) * slope if math.isfinite(v) and v > 0 else -math.inf
                              for lam, v in zip(grid, (found[i].m2 / found[i].n).tolist())]
                best = max(range(points), key=scores.__getitem__)
                if scores[best] == -math.inf:
                    out[c] = None
                elif best in (0, points - 1) and high - low < MAX_BRACKET:
                    ranges[c] = grid[best] - (high - low), grid[best] + (high - low)  # the optimum may lie outside
                elif left[c] == 1:
                    out[c] = _peak(grid, scores)
                else:
                    left[c] -= 1
                    ranges[c] = grid[best] - (grid[1] - grid[0]), grid[best] + (grid[1] - grid[0])
    finally:
        data.unpersist()
    return out


def fit_power(train: DataFrame, cols: Sequence[str], kind: str = "yeo-johnson") -> dict[str, dict]:
    """C02/B05 fit: lambda per column, then mean/std (population) of the transformed train
    column for standardisation (one aggregate for all columns); columns whose fit fails or whose
    transformed std <= 1e-6 are marked for the ``log1p(max(x, 0))`` fallback."""
    lams = fit_lambdas(train, cols, kind)
    params: dict[str, dict] = {c: {"fallback": True} for c in cols}
    known = [c for c in cols if lams[c] is not None]
    if not known:
        return params
    t = _power(kind, F.col("x"), _by_column([lams[c] for c in known]))
    for r in _long(train, known).select("c", t.alias("t")).groupBy("c").agg(
            F.avg("t").alias("m"), F.stddev_pop("t").alias("s"), (F.min("t") < F.max("t")).alias("varies")).collect():
        ok = r["s"] is not None and math.isfinite(r["s"]) and r["s"] > 1e-6 and r["varies"]
        params[known[r["c"]]] = {"fallback": not ok, "lambda": lams[known[r["c"]]], "mean": r["m"], "std": r["s"]}
    return params


def apply_power(df: DataFrame, params: dict[str, dict], kind: str = "yeo-johnson",
                standardize: bool = True) -> DataFrame:
    """C02/B05 apply: standardised transform, or the log1p fallback."""
    tf = yeo_johnson if kind == "yeo-johnson" else box_cox
    specs = []
    for c, p in params.items():
        if c not in df.columns:
            continue
        if p["fallback"]:
            specs.append((c, F.log1p(F.greatest(col(c).cast("double"), F.lit(0.0)))))
        else:
            t = tf(col(c), p["lambda"])
            specs.append((c, (t - F.lit(p["mean"])) / F.lit(p["std"]) if standardize else t))
    return with_columns(df, specs)


def skewness_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population skewness of each column (scipy's default), one aggregate, long form."""
    a = df.agg(*[F.skewness(col(c)).alias(f"s{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("skew"))
                                for i, c in enumerate(cols)]))
    return a.select(stack.alias("s")).select("s.*")


def unskew(train: DataFrame, test: DataFrame, cols: Sequence[str], threshold: float = 0.75,
           exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, dict]:
    """Yeo-Johnson (standardised) for continuous columns with |skew| > threshold, fitted
    on train.  The target must be excluded explicitly (test has none)."""
    cand = [c for c in cols if c not in set(exclude)]
    sk = {r["column"]: r["skew"] for r in skewness_table(train, cand).collect()}
    skewed = [c for c in cand if sk.get(c) is not None and abs(sk[c]) > threshold]
    params = fit_power(train, skewed)
    return apply_power(train, params), apply_power(test, params), params


def skew_report(df: DataFrame, cols: Sequence[str], threshold: float = 0.75, top: int = 5) -> DataFrame:
    """Columns with |skew| > threshold, the ``top`` highest skew first."""
    t = skewness_table(df, cols)
    return t.where(F.abs("skew") > threshold).orderBy(F.desc("skew"), "column").limit(top)


# ---------------------------------------------------------------- B06 / C03
def norm_ppf(p: Column) -> Column:
    """Inverse standard-normal CDF (Acklam's rational approximation, rel. error ~1e-9)."""
    # The published coefficients of the approximation.
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02,
         -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01,
         -1.328068155288572e01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00,
         4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00]
    plow = 0.02425

    def poly(coefs, x):
        out = F.lit(coefs[0])
        for k in coefs[1:]:
            out = out * x + F.lit(k)
        return out

    q_low = F.sqrt(-2 * F.log(p))
    low = poly(c, q_low) / (poly(d, q_low) * q_low + 1)
    q = p - 0.5
    r = q * q
    central = poly(a, r) * q / (poly(b, r) * r + 1)
    q_high = F.sqrt(-2 * F.log(1 - p))
    high = -poly(c, q_high) / (poly(d, q_high) * q_high + 1)
    return F.when(p < plow, low).when(p <= 1 - plow, central).otherwise(high)


def fit_quantile_normal(train: DataFrame, c: str, n_quantiles: int = 1000) -> tuple[list[float], list[float]]:
    """B06/C03 fit: ``n_quantiles`` landmarks (exact distributed quantiles) with their
    reference probabilities; duplicate landmarks share the mean probability."""
    n = train.where(col(c).isNotNull()).count()
    k = max(2, min(n_quantiles, n))
    refs = [i / (k - 1) for i in range(k)]
    qs = group_quantiles(train, [], c, refs).orderBy("p_idx").collect()
    marks: dict[float, list[float]] = {}
    for r in qs:
        marks.setdefault(float(r["q"]), []).append(float(r["p"]))
    xs = sorted(marks)
    ys = [sum(marks[x]) / len(marks[x]) for x in xs]
    return xs, ys


def apply_quantile_normal(df: DataFrame, c: str, xs: Sequence[float], ys: Sequence[float], out: str | None = None,
                          eps: float = 1e-7) -> DataFrame:
    """B06/C03 apply: piecewise-linear map to [0, 1] via the landmarks (found with
    MLlib's ``Bucketizer`` binary search, JVM-side), clipped, then the normal quantile."""
    from pyspark.ml.feature import Bucketizer

    out = out or c
    x = col(c).cast("double")
    if len(xs) < 2:
        return with_columns(df, [(out, F.lit(0.0))])
    splits = [-float("inf"), *xs[1:-1], float("inf")]
    tmp = df.withColumn("_qx", x)
    b = Bucketizer(splits=splits, inputCol="_qx", outputCol="_qb", handleInvalid="keep").transform(tmp)
    xa, ya = F.array(*[F.lit(float(v)) for v in xs]), F.array(*[F.lit(float(v)) for v in ys])
    i = F.col("_qb").cast("int") + 1
    x0, x1 = F.element_at(xa, i), F.element_at(xa, i + 1)
    y0, y1 = F.element_at(ya, i), F.element_at(ya, i + 1)
    u = F.when(F.col("_qx") <= F.lit(xs[0]), F.lit(ys[0])).when(F.col("_qx") >= F.lit(xs[-1]), F.lit(ys[-1])) \
        .otherwise(y0 + (F.col("_qx") - x0) / (x1 - x0) * (y1 - y0))
    u = F.least(F.greatest(u, F.lit(eps)), F.lit(1 - eps))
    res = b.withColumn(out, F.when(F.col("_qx").isNull(), F.lit(None)).otherwise(norm_ppf(u)))
    return res.drop("_qx", "_qb")


# ---------------------------------------------------------------- C05
# Limits a metric has to keep, and the remarks of the report.
DEFAULT_THRESHOLDS = {"abs_skew": 0.5, "abs_excess_kurt": 1.0, "jb_pvalue": 0.05, "ks_norm": 0.08}
REMARKS = {"jb_stat": "smaller is better", "jb_pvalue": ">= alpha passes"}


def moments(df: DataFrame, by: str, value: str) -> DataFrame:
    """n, mean and central moments m2..m4 per series in two partial aggregates."""
    x = col(value).cast("double")
    base = df.where(x.isNotNull() & ~F.isnan(x)).select(col(by), x.alias("_x"))
    mean = base.groupBy(col(by)).agg(F.avg("_x").alias("_m"))
    j = base.join(broadcast_if_small(mean), by)
    d = F.col("_x") - F.col("_m")
    return j.groupBy(col(by)).agg(F.count(F.lit(1)).alias("n"), F.first("_m").alias("mean"),
                                  F.avg(d * d).alias("m2"), F.avg(d * d * d).alias("m3"), F.avg(d * d * d * d).alias("m4"))


def _metric(name: str, value: Column, limit: float | None) -> Column:
    """A report row: p-values must reach their limit, other metrics must not pass it; without a limit no verdict."""
    verdict = F.lit(None) if limit is None else (value >= limit if name.endswith("pvalue") else value <= limit)
    return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), F.lit(limit).cast("double").alias("threshold"),
                    verdict.cast("boolean").alias("pass"), F.lit(REMARKS.get(name, "")).alias("note"))


def evaluate_many(df: DataFrame, by: str, value: str, thresholds: dict | None = None,
                  include_ks: bool = False) -> DataFrame:
    """Per series |skew| and |excess kurtosis| (bias-corrected), Jarque-Bera statistic
    and p-value (uncorrected moments, chi2(2) tail = exp(-JB/2)), optionally the KS distance
    to a fitted normal, and ``overall_pass`` over the metrics with a verdict."""
    limits = DEFAULT_THRESHOLDS | (thresholds or {})
    m = moments(df, by, value)
    n = F.col("n").cast("double")
    skew = F.col("m3") / F.pow(F.col("m2"), 1.5)
    excess = F.col("m4") / (F.col("m2") * F.col("m2")) - 3
    jb = n * (skew * skew + excess * excess / 4) / 6
    metrics = {"abs_skew": F.abs(skew * F.sqrt(n * (n - 1)) / (n - 2)),
               "abs_excess_kurt": F.abs(((n + 1) * excess + 6) * (n - 1) / ((n - 2) * (n - 3))),
               "jb_stat": jb, "jb_pvalue": F.exp(-jb / 2)}
    report = m.select(col(by).alias("series"), F.inline(F.array(*[_metric(k, v, limits.get(k)) for k, v in metrics.items()])))
    if include_ks:
        report = report.unionByName(ks_normal(df, by, value, limits["ks_norm"]))
    report = report.withColumn("value", F.round("value", 3))
    overall = report.groupBy("series").agg(F.coalesce(F.bool_and("pass"), F.lit(False)).alias("overall_pass"))
    return report.join(overall, "series", "left")


# Coefficients of a published rational approximation of erf (error below 1.5e-7).
ERF_P, ERF_A = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, within 1e-7."""
    a = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + ERF_P * a)
    poly = F.lit(0.0)
    for c in reversed(ERF_A):
        poly = (poly + c) * t
    erf = 1 - poly * F.exp(-a * a)
    return F.when(z < 0, (1 - erf) / 2).otherwise((1 + erf) / 2)


def ks_normal(df: DataFrame, by: str, value: str, threshold: float = 0.08) -> DataFrame:
    """C05 KS part: distance of each series to a normal with its mean and population std.

    All series share one ordered pass: a global row number over (series, value) gives each value its
    rank, and the distance is the largest gap to the distribution function on either side of a value."""
    from plinth.functions.ordered import global_row_number

    x = col(value).cast("double")
    data = df.where(x.isNotNull() & ~F.isnan(x)).select(col(by).alias("series"), x.alias("_x"))
    m = moments(df, by, value).select(col(by).alias("_by"), "n", "mean", F.sqrt("m2").alias("sd"))
    ranked = global_row_number(data, ["series", "_x"], "_rn")
    first = ranked.groupBy("series").agg(F.min("_rn").alias("_first")).withColumnRenamed("series", "_of")
    params = m.join(first, F.col("_by").eqNullSafe(F.col("_of"))).drop("_of")
    j = ranked.join(broadcast_if_small(params), F.col("series").eqNullSafe(F.col("_by")))
    below = (F.col("_rn") - F.col("_first")) / F.col("n")
    p = normal_cdf((F.col("_x") - F.col("mean")) / F.greatest(F.col("sd"), F.lit(1e-12)))
    stat = F.max(F.greatest(p - below, below + 1 / F.col("n") - p))
    return j.groupBy("series").agg(stat.alias("_d")).select("series", F.inline(F.array(_metric("ks_norm", F.col("_d"), threshold))))
