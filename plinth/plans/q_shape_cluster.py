"""Queries for distribution-shape transforms (B05, B06, C02-C05) and clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators import cluster as cl
from plinth.operators import shape as sh
from plinth.plans.catalog import register
from plinth.plans.common import filled, round_doubles
from plinth.plans.facts import table

CUT = "2024-01-21"


def event_pair(spark, d) -> tuple[DataFrame, DataFrame]:
    """Events as a train/test pair: runs before the cut-off day train, later ones test."""
    ev = table(spark, d, "events").select(
        "event_id", "ts", "event_type", "value", "user_id",
        F.regexp_extract("props", r'"k": (\d+)', 1).cast("double").alias("k"))
    cut = F.lit(CUT).cast("timestamp")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


# ---------------------------------------------------------------- C02 with a fixed lambda (S)
LAM = 0.25
YJ_SQL = f"""CASE WHEN value >= 0 THEN (pow(value + 1, {LAM}) - 1) / {LAM}
             ELSE -(pow(1 - value, {2 - LAM}) - 1) / {2 - LAM} END"""
C02F_SQL = f"""WITH t AS (SELECT event_id, ts, {YJ_SQL} AS t FROM events),
st AS (SELECT avg(t) AS m, stddev_pop(t) AS s FROM t WHERE ts < TIMESTAMP '{CUT}')
SELECT event_id, round((t - m) / s, 6) AS value FROM t CROSS JOIN st"""


@register("c02_yeo_johnson_apply", C02F_SQL)
def c02_yeo_johnson_apply(spark, d):
    tr, te = event_pair(spark, d)
    t = sh.yeo_johnson(F.col("value"), LAM)
    r = tr.agg(F.avg(t).alias("m"), F.stddev_pop(t).alias("s")).first()
    params = {"value": {"fallback": False, "lambda": LAM, "mean": r["m"], "std": r["s"]}}
    out = sh.apply_power(tr, params).unionByName(sh.apply_power(te, params))
    return round_doubles(out.select("event_id", "value"))


# ---------------------------------------------------------------- C02 full fit (R)
@register("c02_unskew")
def c02_unskew(spark, d):
    tr, te = event_pair(spark, d)
    a, b, params = sh.unskew(tr, te, ["value", "user_id", "k"])
    lam = {c: p.get("lambda") for c, p in params.items()}
    out = a.unionByName(b).select("event_id", "value", "user_id", "k")
    return out.withColumn("lambda_value", F.lit(lam.get("value")).cast("double"))


# ---------------------------------------------------------------- B05 (R)
@register("b05_box_cox")
def b05_box_cox(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    params = sh.fit_power(o, ["o_totalprice"], "box-cox")
    out = sh.apply_power(o, params, "box-cox", standardize=False)
    return out.withColumn("lambda", F.lit(params["o_totalprice"].get("lambda")).cast("double"))


# ---------------------------------------------------------------- C02 / B05: the fitted lambda against a grid (S)
LAMBDA_GRID = "SELECT (i - 100) / CAST(20 AS DOUBLE) AS lam FROM range(201) AS t(i)"


def _best_lambda_sql(name: str, rows: str, transform: str, slope: str) -> str:
    """The lambda of a grid (-5 to 5 by 0.05) with the largest likelihood."""
    return f"""SELECT '{name}' AS "column", arg_max(lam, score) AS lambda FROM (
  SELECT lam, -ln(var_pop({transform})) / 2 + (lam - 1) * avg({slope}) AS score
  FROM ({rows}) AS x CROSS JOIN ({LAMBDA_GRID}) AS g GROUP BY lam)"""


YJ_GRID_SQL = """CASE WHEN x >= 0 THEN CASE WHEN lam = 0 THEN ln(1 + x) ELSE (pow(x + 1, lam) - 1) / lam END
             ELSE CASE WHEN lam = 2 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - lam) - 1) / (2 - lam) END END"""
FITTED_COLS = {"value": "value", "user_id": "CAST(user_id AS DOUBLE)", "k": """CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE)"""}
C02L_SQL = " UNION ALL ".join(
    _best_lambda_sql(c, f"SELECT {x} AS x FROM events WHERE ts < TIMESTAMP '{CUT}'", YJ_GRID_SQL, "sign(x) * ln(1 + abs(x))")
    for c, x in FITTED_COLS.items())
B05L_SQL = _best_lambda_sql("o_totalprice", "SELECT o_totalprice AS x FROM orders WHERE o_totalprice > 0",
                            "CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END", "ln(x)")


def _nearest_on_grid(spark, lambdas: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(c, round(v * 20) / 20 + 0.0) for c, v in lambdas.items()], "column string, lambda double")


@register("c02_fitted_lambdas", C02L_SQL)
def c02_fitted_lambdas(spark, d):
    tr, _ = event_pair(spark, d)
    return _nearest_on_grid(spark, sh.fit_lambdas(tr, list(FITTED_COLS)))


@register("b05_fitted_lambda", B05L_SQL)
def b05_fitted_lambda(spark, d):
    return _nearest_on_grid(spark, sh.fit_lambdas(table(spark, d, "orders"), ["o_totalprice"], "box-cox"))


# ---------------------------------------------------------------- B06 / C03 (R)
@register("b06_quantile_normal_target")
def b06_quantile_normal_target(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    xs, ys = sh.fit_quantile_normal(o, "o_totalprice", 1000)
    return sh.apply_quantile_normal(o, "o_totalprice", xs, ys, "target_normal")


@register("c03_quantile_transform")
def c03_quantile_transform(spark, d):
    tr, te = event_pair(spark, d)
    xs, ys = sh.fit_quantile_normal(tr, "value", 1000)
    return sh.apply_quantile_normal(tr.unionByName(te), "value", xs, ys, "value_normal").select(
        "event_id", "value", "value_normal")


# ---------------------------------------------------------------- C04 (S)
C04_COLS = ["value", "value_sq", "log_value", "user_id", "k"]


def _c04_frame(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select((F.col("value")).alias("value"), (F.col("value") * F.col("value")).alias("value_sq"),
                     F.log("value").alias("log_value"), F.col("user_id").cast("double").alias("user_id"),
                     F.regexp_extract("props", r'"k": (\d+)', 1).cast("double").alias("k"))


def _pop_skew_sql(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS skew "
            f"FROM x CROSS JOIN (SELECT avg({c}) AS m FROM x)")


C04_SQL = f"""WITH x AS (SELECT value, value * value AS value_sq, ln(value) AS log_value, CAST(user_id AS DOUBLE) AS user_id,
  CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k FROM events),
s AS ({' UNION ALL '.join(_pop_skew_sql(c) for c in C04_COLS)})
SELECT "column", round(skew, 6) AS skew FROM s WHERE abs(skew) > 0.75 ORDER BY skew DESC, "column" LIMIT 5"""


@register("c04_skew_report", C04_SQL)
def c04_skew_report(spark, d):
    return round_doubles(sh.skew_report(_c04_frame(spark, d), C04_COLS))


# ---------------------------------------------------------------- C05 (S without KS)
C05_SQL = """WITH b AS (SELECT event_type AS series, value AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
m AS (SELECT series, avg(x) AS mu FROM b GROUP BY series),
mo AS (SELECT b.series, count(*) AS n, avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4
       FROM b JOIN m ON m.series = b.series GROUP BY b.series),
g AS (SELECT series, CAST(n AS DOUBLE) AS n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM mo),
v AS (SELECT series, g1 * sqrt(n * (n - 1)) / (n - 2) AS sk, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)) AS ku,
             n / 6 * (g1 * g1 + g2 * g2 / 4) AS jb FROM g),
r AS (
  SELECT series, 'abs_skew' AS metric, abs(sk) AS value, 0.5 AS threshold, abs(sk) <= 0.5 AS pass, '' AS note FROM v
  UNION ALL SELECT series, 'abs_excess_kurt', abs(ku), 1.0, abs(ku) <= 1.0, '' FROM v
  UNION ALL SELECT series, 'jb_stat', jb, CAST(NULL AS DOUBLE), CAST(NULL AS BOOLEAN), 'smaller is better' FROM v
  UNION ALL SELECT series, 'jb_pvalue', exp(-jb / 2), 0.05, exp(-jb / 2) >= 0.05, '>= alpha passes' FROM v
)
SELECT r.series, metric, round(value, 3) AS value, threshold, pass, note, o.overall_pass
FROM r JOIN (SELECT series, coalesce(bool_and(pass), false) AS overall_pass FROM r GROUP BY series) o ON o.series = r.series"""


@register("c05_distribution_report", C05_SQL)
def c05_distribution_report(spark, d):
    return sh.evaluate_many(table(spark, d, "events"), "event_type", "value")


_T = "(1 / (1 + 0.3275911 * abs(z) / sqrt(2.0)))"
_ERF = f"""(1 - ((((1.061405429 * {_T} - 1.453152027) * {_T} + 1.421413741) * {_T} - 0.284496736) * {_T} + 0.254829592) * {_T}
  * exp(-z * z / 2))"""
C05_KS_SQL = f"""WITH s AS (SELECT event_type AS series, count(value) AS n, avg(value) AS m, stddev_pop(value) AS sd FROM events
  WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1),
r AS (SELECT s.series, n, (value - m) / greatest(sd, 1e-12) AS z,
  row_number() OVER (PARTITION BY s.series ORDER BY value) - 1 AS k FROM events e JOIN s ON s.series = e.event_type
  WHERE value IS NOT NULL AND NOT isnan(value)),
p AS (SELECT series, n, k, CASE WHEN z < 0 THEN (1 - {_ERF}) / 2 ELSE (1 + {_ERF}) / 2 END AS p FROM r)
SELECT series, 'ks_norm' AS metric, round(max(greatest(p - k / n, (k + 1) / n - p)), 3) AS value, CAST(0.08 AS DOUBLE) AS threshold,
  max(greatest(p - k / n, (k + 1) / n - p)) <= 0.08 AS pass, '' AS note FROM p GROUP BY 1"""


@register("c05_ks_normal", C05_KS_SQL)
def c05_ks_normal(spark, d):
    out = sh.ks_normal(table(spark, d, "events"), "event_type", "value")
    return out.withColumn("value", F.round("value", 3))


# ---------------------------------------------------------------- E01 / E02 (R)
E_COLS = ["n_lines", "sum_qty", "sum_price", "avg_disc", "acctbal", "order_year", "order_month"]


@register("e01_kmeans_clusters")
def e01_kmeans_clusters(spark, d):
    f = filled(spark, d)
    tr, te = cl.kmeans_feature(f.where("is_train"), f.where("NOT is_train"), E_COLS, k=4)
    return tr.unionByName(te).select("okey", "Cluster")


@register("e02_multi_kmeans")
def e02_multi_kmeans(spark, d):
    f = filled(spark, d).select("okey", "is_train", *E_COLS)
    configs = {"Size": (["n_lines", "sum_qty", "sum_price"], [3, 5]), "Money": (["sum_price", "acctbal"], [4, 6]),
               "Location": (["Neighborhood"], [6, 8])}
    tr, te = cl.multi_kmeans(f.where("is_train"), f.where("NOT is_train"), configs)
    return tr.unionByName(te).select("okey", *[c for c in tr.columns if "_k" in c])
