"""Queries for metrics and error analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.sizing import broadcast_if_small
from plinth.operators import evaluate as ev
from plinth.plans.catalog import register
from plinth.plans.common import ERRORS_CTE, filled, nation_mean_predictions, round_doubles

ERR_COLS = ("error_log", "error_log_abs", "error_real", "error_real_abs", "error_real_pct")


def _errors(spark, d) -> DataFrame:
    return nation_mean_predictions(filled(spark, d))


# ---------------------------------------------------------------- L03 (flagship)
L03_SQL = f"""
WITH {ERRORS_CTE},
edges AS (
  SELECT list_sort(list_distinct(quantile_cont(sum_price, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
  FROM errors
),
binned AS (
  SELECT errors.*, greatest(1, len(list_filter(e, lambda x: x < sum_price))) AS bin, e
  FROM errors CROSS JOIN edges
)
SELECT CAST(bin AS INTEGER) AS bin, round(e[bin], 6) AS lower, round(e[least(bin + 1, len(e))], 6) AS upper,
       count(*) AS count, round(avg(error_log_abs), 6) AS mean_error_log_abs,
       round(avg(error_real_abs), 6) AS mean_error_real_abs, round(avg(abs(error_real_pct)), 6) AS mean_error_pct,
       round(stddev_samp(error_log_abs), 6) AS std_error_log_abs
FROM binned GROUP BY bin, e
"""


@register("l03_error_by_decile", L03_SQL)
def l03_error_by_decile(spark, d):
    """Flagship: facts -> fill -> fitted group-mean predictor -> errors -> decile segments."""
    return round_doubles(ev.errors_by_feature(_errors(spark, d), "sum_price", n_bins=10))


L03C_SQL = f"""
WITH {ERRORS_CTE}
SELECT segment AS feature_value, count(*) AS count, round(avg(error_log_abs), 6) AS mean_error_log_abs,
       round(avg(error_real_abs), 6) AS mean_error_real_abs, round(avg(abs(error_real_pct)), 6) AS mean_error_pct,
       round(stddev_samp(error_log_abs), 6) AS std_error_log_abs
FROM errors GROUP BY segment
"""


@register("l03_error_by_category", L03C_SQL)
def l03_error_by_category(spark, d):
    return round_doubles(ev.errors_by_feature(_errors(spark, d), "segment"))


# ---------------------------------------------------------------- L01
L01_SQL = f"""
WITH {ERRORS_CTE}
SELECT is_train, round(avg(pow(y - pred, 2)), 6) AS mse, round(sqrt(avg(pow(y - pred, 2))), 6) AS rmse,
       count(*) AS n,
       round(sqrt(avg(pow((exp(y) - 1) - least(greatest(exp(pred) - 1, 0.0), 10000000.0), 2))), 6) AS rmse_real
FROM errors GROUP BY is_train
"""


@register("l01_metrics", L01_SQL)
def l01_metrics(spark, d):
    e = _errors(spark, d)
    parts = [ev.regression_metrics(e.where(F.col("is_train") == flag), "y", "pred").select(F.lit(flag).alias("is_train"), "*")
             for flag in (True, False)]
    return round_doubles(parts[0].unionByName(parts[1]))


# ---------------------------------------------------------------- L02
L02_SQL = f"""
WITH {ERRORS_CTE}
SELECT okey, round(error_log, 6) AS error_log, round(error_log_abs, 6) AS error_log_abs,
       round(error_real, 4) AS error_real, round(error_real_abs, 4) AS error_real_abs,
       round(error_real_pct, 6) AS error_real_pct
FROM errors
"""


@register("l02_error_columns", L02_SQL)
def l02_error_columns(spark, d):
    e = _errors(spark, d)
    return e.select("okey", *[F.round(c, 4 if c in ("error_real", "error_real_abs") else 6).alias(c) for c in ERR_COLS])


# ---------------------------------------------------------------- L04
L04_SQL = f"""
WITH {ERRORS_CTE},
top AS (SELECT okey, error_log_abs FROM errors ORDER BY error_log_abs DESC, okey LIMIT 50)
SELECT top.okey, round(top.error_log_abs, 6) AS error_log_abs, f.nation, f.segment, round(f.sum_price, 2) AS sum_price
FROM top JOIN filled f ON f.okey = top.okey
"""


@register("l04_worst_rows", L04_SQL)
def l04_worst_rows(spark, d):
    e = _errors(spark, d).select("okey", "error_log_abs")
    feats = filled(spark, d).select("okey", "nation", "segment", "sum_price")
    out = ev.worst_rows(e, feats, "okey", 50)
    return round_doubles(out.select("okey", "error_log_abs", "nation", "segment", F.round("sum_price", 2).alias("sum_price")))


# ---------------------------------------------------------------- L05
L05_SQL = f"""
WITH {ERRORS_CTE}
SELECT round(avg(error_log_abs), 6) AS mae_log, round(avg(error_real_abs), 4) AS mae_real,
       round(avg(abs(error_real_pct)), 6) AS mape, round(sqrt(avg(error_log * error_log)), 6) AS rmse_log,
       count(*) AS n
FROM errors
"""


@register("l05_error_summary", L05_SQL)
def l05_error_summary(spark, d):
    s = ev.error_summary(_errors(spark, d))
    return round_doubles(s).withColumn("mae_real", F.round("mae_real", 4))


# ---------------------------------------------------------------- L06
L06_SQL = f"""
WITH {ERRORS_CTE},
worst AS (SELECT * FROM errors ORDER BY error_log_abs DESC, okey LIMIT 50),
r1 AS (
  SELECT 'Is_New = order_year > 1995' AS rule,
         (count(*) > 0 AND sum(CASE WHEN order_year > 1995 THEN 1 ELSE 0 END) > count(*) * 0.3) AS fired,
         CAST(sum(CASE WHEN order_year > 1995 THEN 1 ELSE 0 END) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) AS detail
  FROM worst
),
seg AS (SELECT nation, avg(error_log_abs) AS m FROM errors GROUP BY nation),
top5 AS (SELECT nation FROM seg ORDER BY m DESC, nation LIMIT 5),
r2 AS (
  SELECT 'HighError groups' AS rule, count(*) > 0 AS fired,
         string_agg(nation, ', ' ORDER BY m DESC, nation) AS detail
  FROM (SELECT top5.nation, seg.m FROM top5 JOIN seg USING (nation))
)
SELECT * FROM r1 UNION ALL SELECT * FROM r2
UNION ALL SELECT * FROM (VALUES ('Quality x age', true, 'n_lines * (2024 - order_year)'), ('Remodel age', true, 'order_month - order_year'),
  ('Is remodelled', true, 'order_month != order_year'), ('Squared quality', true, 'n_lines ** 2')) v(rule, fired, detail)
WHERE EXISTS (SELECT 1 FROM worst)
"""


@register("l06_feature_suggestions", L06_SQL)
def l06_feature_suggestions(spark, d):
    e = _errors(spark, d)
    worst = e.orderBy(F.desc("error_log_abs"), "okey").limit(50)
    by_nation = ev.errors_by_feature(e, "nation")
    return ev.feature_suggestions(worst, "order_year", 1995, by_nation, quality="n_lines", remodelled="order_month",
                                  by_quality=ev.errors_by_feature(e, "priority"))


# ---------------------------------------------------------------- L07-L10: several fitted predictors
MODELS = ("pred_nation", "pred_segment", "pred_priority")

PREDS_CTE = f"""{ERRORS_CTE},
ms AS (SELECT segment, avg(y) AS m FROM filled WHERE is_train GROUP BY segment),
mp AS (SELECT priority, avg(y) AS m FROM filled WHERE is_train GROUP BY priority),
wide AS (
  SELECT e.okey, e.y, e.pred AS pred_nation, coalesce(ms.m, gl.m) AS pred_segment, coalesce(mp.m, gl.m) AS pred_priority
  FROM errors e LEFT JOIN ms ON ms.segment = e.segment LEFT JOIN mp ON mp.priority = e.priority CROSS JOIN gl
)"""


def wide_predictions(spark, d) -> DataFrame:
    """Three group-mean predictors fitted on the training part, one column each (all
    group means and the global mean come from one grouping-sets aggregate)."""
    from plinth.plans.common import group_mean_tables

    f = filled(spark, d)
    tables, glob, n = group_mean_tables(f.where("is_train"), ["nation", "segment", "priority"])
    out = f.select("okey", "y", "nation", "segment", "priority")
    for g in ("nation", "segment", "priority"):
        m = tables[g].withColumnRenamed("_m", f"_m_{g}")
        out = out.join(broadcast_if_small(m, bound=n), g, "left").withColumn(
            f"pred_{g}", F.coalesce(F.col(f"_m_{g}"), F.lit(glob))).drop(f"_m_{g}")
    return out.select("okey", "y", *MODELS)


L07_SQL = f"""
WITH {PREDS_CTE}
SELECT * FROM (
  SELECT 'pred_nation' AS model_a, 'pred_segment' AS model_b, round(corr(pred_nation, pred_segment), 6) AS corr FROM wide
  UNION ALL SELECT 'pred_nation', 'pred_priority', round(corr(pred_nation, pred_priority), 6) FROM wide
  UNION ALL SELECT 'pred_segment', 'pred_priority', round(corr(pred_segment, pred_priority), 6) FROM wide
) t
"""


@register("l07_prediction_correlation", L07_SQL)
def l07_prediction_correlation(spark, d):
    out = ev.prediction_correlations(wide_predictions(spark, d), MODELS).drop("high")
    return round_doubles(out)


L08_SQL = f"""
WITH {PREDS_CTE},
long AS (
  SELECT model, value FROM wide UNPIVOT (value FOR model IN (pred_nation, pred_segment, pred_priority))
  UNION ALL SELECT 'train' AS model, y AS value FROM filled WHERE is_train
)
SELECT model, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(max(value), 6) AS max, count(value) AS n, round(quantile_cont(value, 0.25), 6) AS q25,
       round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75
FROM long GROUP BY model HAVING avg(value) < 10000000
"""


@register("l08_distribution_by_model", L08_SQL)
def l08_distribution_by_model(spark, d):
    w = wide_predictions(spark, d)
    ref = filled(spark, d).where("is_train")
    long = ev.melt_predictions(w, "okey", MODELS, ref, "y")
    return round_doubles(ev.distribution_by_model(long))


L09_SQL = f"""
WITH {PREDS_CTE}
SELECT okey, model, round(value, 6) AS value
FROM wide UNPIVOT (value FOR model IN (pred_nation, pred_segment, pred_priority))
UNION ALL SELECT okey, 'train' AS model, round(y, 6) AS value FROM filled WHERE is_train
"""


@register("l09_melt_predictions", L09_SQL)
def l09_melt_predictions(spark, d):
    w = wide_predictions(spark, d)
    ref = filled(spark, d).where("is_train")
    return round_doubles(ev.melt_predictions(w, "okey", MODELS, ref, "y"))


L10_SQL = f"""
WITH {PREDS_CTE}
SELECT * FROM (
  SELECT 'pred_nation' AS model_a, 'pred_segment' AS model_b, round(avg(pred_nation - pred_segment), 6) AS mean_diff,
         round(stddev_samp(pred_nation - pred_segment), 6) AS std_diff,
         round(max(abs(pred_nation - pred_segment)), 6) AS max_abs_diff, round(corr(pred_nation, pred_segment), 6) AS corr
  FROM wide
  UNION ALL
  SELECT 'pred_nation', 'pred_priority', round(avg(pred_nation - pred_priority), 6),
         round(stddev_samp(pred_nation - pred_priority), 6), round(max(abs(pred_nation - pred_priority)), 6),
         round(corr(pred_nation, pred_priority), 6)
  FROM wide
) t
"""


@register("l10_pairwise_differences", L10_SQL)
def l10_pairwise_differences(spark, d):
    pairs = [("pred_nation", "pred_segment"), ("pred_nation", "pred_priority")]
    return round_doubles(ev.pairwise_differences(wide_predictions(spark, d), pairs))


# ---------------------------------------------------------------- B24 / B25
B24_SQL = f"""WITH {PREDS_CTE},
mixed AS (SELECT okey, pred_nation, exp(pred_segment) - 1 AS pred_segment FROM wide)
SELECT okey, round(pred_nation, 6) AS pred_nation, round(ln(1 + greatest(pred_segment, 0.0)), 6) AS pred_segment FROM mixed"""


@register("b24_log_space_detection", B24_SQL)
def b24_log_space_detection(spark, d):
    from plinth.operators.features import detect_log_space
    w = wide_predictions(spark, d).select("okey", "pred_nation", F.expm1("pred_segment").alias("pred_segment"))
    return round_doubles(detect_log_space(w, ["pred_nation", "pred_segment"]))


B25_SQL = f"""WITH {PREDS_CTE}
SELECT okey, round(least(greatest(exp(least(greatest(pred_nation * 1.05, 0.0), 15.0)) - 1, 10000.0), 2000000.0), 4)
  AS price FROM wide"""


@register("b25_bounded_inverse", B25_SQL)
def b25_bounded_inverse(spark, d):
    from plinth.operators.features import bounded_inverse
    w = wide_predictions(spark, d)
    return w.select("okey", F.round(bounded_inverse(F.col("pred_nation") * 1.05), 4).alias("price"))
