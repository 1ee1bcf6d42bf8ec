"""Queries for feature selection (G01-G10), models (J01-J09) and ensembles.

Model-based operators are randomised/iterative (no SQL oracle); their queries
run MLlib over the whole order-facts table.  Selection arithmetic and the blend
plumbing have oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators import encode as en
from plinth.operators import ensemble as ens
from plinth.operators import folds as fo
from plinth.operators import models as mo
from plinth.operators import select as se
from plinth.operators import tuning
from plinth.plans.catalog import register
from plinth.plans.common import round_doubles
from plinth.plans.q_clean_features import SCORED_CTE, scored
from plinth.plans.q_evaluate import MODELS, PREDS_CTE, wide_predictions
from plinth.session import scratch_path

FEATS = ["n_lines", "sum_qty", "sum_price", "avg_disc", "acctbal", "order_year", "order_month", "ship_year",
         "priority_Score", "status_Score", "Age"]
MODEL_FEATS = ["n_lines", "sum_qty", "sum_price", "avg_disc", "acctbal", "order_year", "order_month",
               "priority_Score", "status_Score"]
GBT = {"maxIter": 10, "maxDepth": 4}
RF = {"numTrees": 10, "maxDepth": 5}


def model_frame(spark, d) -> tuple[DataFrame, DataFrame]:
    """Scored facts with features standardised on train, a stratified ``fold`` column on the
    training rows, ``label = y``.  Returns (train, test)."""
    s = scored(spark, d)
    train = s.where("is_train")
    params = en.fit_standard_scaler(train, MODEL_FEATS)
    s = en.apply_standard_scaler(s, params).withColumn("label", F.col("y"))
    train = fo.stratified_kfold(s.where("is_train"), "okey", "y", 5, 10, 42)
    test = s.where("NOT is_train")
    return train, test


def _corr_rows(feats, src, method, target="y") -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, '{method}' AS method, greatest(abs(coalesce(corr({f}, {target}), 0)), 0.01) AS score "
        f"FROM {src}" for f in feats)


# ---------------------------------------------------------------- G02
G02_SQL = f"""WITH {SCORED_CTE}, tr AS (SELECT * FROM scored WHERE is_train)
SELECT feature, method, round(score, 6) AS score FROM ({_corr_rows(FEATS, 'tr', 'correlation')})"""


@register("g02_correlation_importance", G02_SQL)
def g02_correlation_importance(spark, d):
    s = scored(spark, d).where("is_train")
    return round_doubles(se.correlation_importance(s, "y", FEATS))


# ---------------------------------------------------------------- G04-G06
G04_CTE = f"""{SCORED_CTE}, tr AS (SELECT * FROM scored WHERE is_train),
sc AS ({_corr_rows(FEATS, 'tr', 'corr_train')} UNION ALL {_corr_rows(FEATS, 'scored', 'corr_all')}),
nm AS (SELECT feature, method, CASE WHEN sum(score) OVER (PARTITION BY method) > 0
                                    THEN score / max(score) OVER (PARTITION BY method) ELSE score END AS n,
              CASE method WHEN 'corr_train' THEN 2.0 ELSE 1.0 END AS w FROM sc),
comb AS (SELECT feature, sum(n * w) / 3.0 AS combined FROM nm GROUP BY feature)"""
G04_SQL = f"WITH {G04_CTE} SELECT feature, round(combined, 6) AS combined FROM comb"


def combined_scores(spark, d) -> DataFrame:
    s = scored(spark, d)
    parts = se.correlation_importance(s.where("is_train"), "y", FEATS, method="corr_train").unionByName(
        se.correlation_importance(s, "y", FEATS, method="corr_all"))
    return se.combine_scores(parts, {"corr_train": 2.0, "corr_all": 1.0})


@register("g04_combine_scores", G04_SQL)
def g04_combine_scores(spark, d):
    return round_doubles(combined_scores(spark, d))


G05_SQL = f"""WITH {G04_CTE}
SELECT feature, round(combined, 6) AS combined FROM comb
WHERE combined >= (SELECT quantile_cont(combined, 0.10) FROM comb)"""


@register("g05_select_percentile", G05_SQL)
def g05_select_percentile(spark, d):
    return round_doubles(se.select_by_percentile(combined_scores(spark, d), 10.0))


G06_SQL = f"""WITH {G04_CTE}
SELECT feature, round(combined, 6) AS combined FROM comb ORDER BY combined DESC, feature LIMIT 5"""


@register("g06_select_top_n", G06_SQL)
def g06_select_top_n(spark, d):
    return round_doubles(se.select_top_n(combined_scores(spark, d), 5))


# ---------------------------------------------------------------- G09
def _g09_sql(threshold: float) -> str:
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, corr({a}, {b}) AS c FROM tr"
        for i, a in enumerate(FEATS) for b in FEATS[i + 1:])
    return f"""WITH {SCORED_CTE}, tr AS (SELECT * FROM scored WHERE is_train),
imp AS ({_corr_rows(FEATS, 'tr', 'correlation')}),
pairs AS (SELECT * FROM ({pairs}) WHERE abs(c) > {threshold}),
rem AS (SELECT DISTINCT CASE WHEN coalesce(i1.score, 0) < coalesce(i2.score, 0) THEN p.f1 ELSE p.f2 END AS feature
        FROM pairs p LEFT JOIN imp i1 ON i1.feature = p.f1 LEFT JOIN imp i2 ON i2.feature = p.f2)
SELECT feature, round(score, 6) AS score FROM imp WHERE feature NOT IN (SELECT feature FROM rem)"""


@register("g09_remove_redundant", _g09_sql(0.85))
def g09_remove_redundant(spark, d):
    tr = scored(spark, d).where("is_train")
    imp = se.correlation_importance(tr, "y", FEATS)
    kept, _ = se.remove_redundant(imp.select("feature", F.col("score").alias("combined")),
                                  se.correlation_pairs(tr, FEATS, 0.85))
    return round_doubles(kept.select("feature", F.col("combined").alias("score")))


# ---------------------------------------------------------------- G01/G03/G07/G08/G10 (R)
@register("g01_tree_importance")
def g01_tree_importance(spark, d):
    train, _ = model_frame(spark, d)
    return se.tree_importance(train, "y", MODEL_FEATS, "fold", "gbt", **GBT)


@register("g03_lasso_importance")
def g03_lasso_importance(spark, d):
    train, _ = model_frame(spark, d)
    return se.lasso_importance(train, "y", MODEL_FEATS, "fold")


@register("g07_subset_cv_rmse")
def g07_subset_cv_rmse(spark, d):
    train, _ = model_frame(spark, d)
    sub = MODEL_FEATS[:4]
    v = se.subset_cv_rmse(train, "y", sub, "fold", "rf", **RF)
    return spark.createDataFrame([(",".join(sub), v)], "features string, cv_rmse double")


@register("g08_best_feature_count")
def g08_best_feature_count(spark, d):
    train, _ = model_frame(spark, d)
    n, v = se.best_feature_count(train, "y", MODEL_FEATS, [3, 6], "fold", "rf", **RF)
    return spark.createDataFrame([(n, v)], "n_features int, cv_rmse double")


@register("g10_select_features")
def g10_select_features(spark, d):
    train, _ = model_frame(spark, d)
    return se.select_features(train, "y", MODEL_FEATS, categorical=["nation"], method="percentile",
                              score_methods=("correlation", "lasso"))


# ---------------------------------------------------------------- J (R)
def _cv_table(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "model string, params string, cv_rmse double, cv_std double")


@register("j01_ridge_fit_predict")
def j01_ridge_fit_predict(spark, d):
    train, test = model_frame(spark, d)
    tr = mo.assemble(train, MODEL_FEATS)
    n, s = mo.label_stats(tr)
    model = mo.fit_linear("ridge", 100.0, n=n, y_std=s).fit(tr)
    out = model.transform(mo.assemble(test, MODEL_FEATS))
    return out.select("okey", F.col("prediction").alias("pred_log"), F.expm1("prediction").alias("pred"))


@register("j02_ols_cv")
def j02_ols_cv(spark, d):
    train, _ = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS).select("features", "label", "fold")
    preds = mo.cv_predictions(data, mo.linear_factory("ols"), "fold")
    return mo.fold_rmse(preds, real_space=True, clip=(0.0, 15.0))


# The grids of the linear models.
RIDGE_ALPHAS = [0.01, 0.1, *map(float, range(1, 31))]
LASSO_ALPHAS = RIDGE_ALPHAS
NET_ALPHAS = [0.0001, 0.0005, 0.0007, 0.0008, 0.0009, 0.001, 0.0011, 0.0012, 0.0013, 0.0015, 0.002, 0.005, 0.01]
NET_L1_RATIOS = [0.1, 0.3, 0.5, 0.7, 0.9]


def _linear_grid(spark, d, name: str, grid: list[dict], real_space: bool) -> DataFrame:
    train, _ = model_frame(spark, d)
    res = mo.linear_grid(train, MODEL_FEATS, grid, real_space=real_space)
    show = lambda p: str({k: v for k, v in p.items() if k != "kind"})
    return _cv_table(spark, [(name, show(p), m, s) for p, m, s in res])


@register("j03_ridge_grid")
def j03_ridge_grid(spark, d):
    return _linear_grid(spark, d, "ridge", [{"kind": "ridge", "alpha": a} for a in RIDGE_ALPHAS], True)


@register("j04_lasso_grid")
def j04_lasso_grid(spark, d):
    return _linear_grid(spark, d, "lasso", [{"kind": "lasso", "alpha": a} for a in LASSO_ALPHAS], False)


@register("j05_elasticnet_grid")
def j05_elasticnet_grid(spark, d):
    grid = [{"kind": "elasticnet", "alpha": a, "l1": r} for a in NET_ALPHAS for r in NET_L1_RATIOS]
    return _linear_grid(spark, d, "elastic_net", grid, True)


@register("j06_random_forest_cv")
def j06_random_forest_cv(spark, d):
    train, _ = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS).select("features", "label", "fold")
    m, s = mo.cv_rmse(data, lambda: mo.make_tree("rf", **RF))
    return _cv_table(spark, [("random_forest", str(RF), m, s)])


@register("j07_gbt_cv")
def j07_gbt_cv(spark, d):
    train, _ = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS).select("features", "label", "fold")
    rows = []
    for loss in ("squared", "absolute"):
        m, s = mo.cv_rmse(data, lambda loss=loss: mo.make_tree("gbt", lossType=loss, **GBT))
        rows.append((f"gbt_{loss}", str(GBT), m, s))
    return _cv_table(spark, rows)


@register("j08_hyperparameter_search")
def j08_hyperparameter_search(spark, d):
    """50 trials by successive halving; every trial's row, cut ones too."""
    train, _ = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS).select("features", "label", "fold")
    space = {"maxDepth": (2, 4), "stepSize": (0.05, 0.3, "log"), "subsamplingRate": (0.6, 1.0), "minInstancesPerNode": (1, 10)}
    found = tuning.rung_search(data, space, lambda p: (lambda: mo.make_tree("gbt", maxIter=4, **p)), trials=50, seed=42, threads=8)
    return tuning.trials_table(spark, found)


@register("j09_save_load_model")
def j09_save_load_model(spark, d):
    from pyspark.ml.regression import LinearRegressionModel
    train, test = model_frame(spark, d)
    tr = mo.assemble(train, MODEL_FEATS)
    n, s = mo.label_stats(tr)
    model = mo.fit_linear("ridge", 10.0, n=n, y_std=s).fit(tr)
    path = scratch_path(spark, "model")
    mo.save_model(model, path)
    loaded = mo.load_model(LinearRegressionModel, path)
    return loaded.transform(mo.assemble(test, MODEL_FEATS)).select("okey", F.col("prediction").alias("pred_log"))


# ---------------------------------------------------------------- K01-K03, K08 (S)
K01_SQL = f"WITH {PREDS_CTE} SELECT okey, {', '.join(f'round({m}, 6) AS {m}' for m in MODELS)} FROM wide"


def _long_preds(spark, d) -> DataFrame:
    w = wide_predictions(spark, d)
    return w.unpivot(["okey"], list(MODELS), "model", "pred")


@register("k01_align_predictions", K01_SQL)
def k01_align_predictions(spark, d):
    w = wide_predictions(spark, d)
    frames = {m: w.select("okey", F.col(m).alias("pred")) for m in MODELS}
    return round_doubles(ens.align_predictions(frames, "okey"))


WEIGHTS = {"pred_nation": 0.5, "pred_segment": 0.0, "pred_priority": 0.3}
W_SQL = " UNION ALL ".join(f"SELECT '{m}' AS model, CAST({w} AS DOUBLE) AS weight" for m, w in WEIGHTS.items())

K02_SQL = f"""WITH {PREDS_CTE}, wt AS ({W_SQL}),
lp AS (SELECT okey, model, pred FROM wide UNPIVOT (pred FOR model IN ({', '.join(MODELS)})))
SELECT lp.okey, lp.model, round(lp.pred, 6) AS pred, wt.weight FROM lp JOIN wt ON wt.model = lp.model WHERE wt.weight > 0"""


def _weights(spark) -> DataFrame:
    return spark.createDataFrame(list(WEIGHTS.items()), "model string, weight double")


@register("k02_active_model_predictions", K02_SQL)
def k02_active_model_predictions(spark, d):
    act = ens.active_models(_weights(spark))
    return round_doubles(_long_preds(spark, d).join(act, "model"))


K03_SQL = f"""WITH {PREDS_CTE}, wt AS ({W_SQL}),
lp AS (SELECT okey, model, pred FROM wide UNPIVOT (pred FOR model IN ({', '.join(MODELS)}))),
b AS (SELECT okey, sum(weight * pred) / sum(weight) AS b FROM lp JOIN wt ON wt.model = lp.model WHERE weight > 0 GROUP BY okey)
SELECT okey, round(least(greatest(exp(least(greatest(b, 0.0), 15.0)) - 1, 10000.0), 2000000.0), 4) AS blend FROM b"""


@register("k03_weighted_blend", K03_SQL)
def k03_weighted_blend(spark, d):
    out = ens.blend(_long_preds(spark, d), _weights(spark), "okey", log_space=True)
    return out.select("okey", F.round("blend", 4).alias("blend"))


K08_SQL = f"""WITH {PREDS_CTE},
lp0 AS (SELECT w.okey, {', '.join('w.' + m for m in MODELS)} FROM wide w JOIN filled f ON f.okey = w.okey WHERE NOT f.is_train),
lp AS (SELECT okey, model, pred FROM lp0 UNPIVOT (pred FOR model IN ({', '.join(MODELS)})))
SELECT 'two_models' AS variant, okey, model, round(pred, 6) AS pred, 'oof' AS source FROM lp
  WHERE model IN ('pred_nation', 'pred_segment')
UNION ALL
SELECT 'all_models', okey, model, round(pred, 6), 'tables' FROM lp"""


@register("k08_blend_source", K08_SQL)
def k08_blend_source(spark, d):
    from plinth.plans.common import filled
    test_keys = filled(spark, d).where("NOT is_train").select("okey")
    lp = _long_preds(spark, d).join(test_keys, "okey", "left_semi")
    oof_test = lp.where(F.col("model") != "pred_priority")
    a = ens.choose_blend_source(oof_test, lp, "okey", ["pred_nation", "pred_segment"])
    b = ens.choose_blend_source(oof_test, lp, "okey", list(MODELS))
    out = a.select(F.lit("two_models").alias("variant"), "*").unionByName(b.select(F.lit("all_models").alias("variant"), "*"))
    return round_doubles(out)


# ---------------------------------------------------------------- K04-K07 (R)
@register("k04_optimize_blend_weights")
def k04_optimize_blend_weights(spark, d):
    w = wide_predictions(spark, d)
    weights = ens.optimize_weights(w, list(MODELS), "y")
    rmse = ens.blend_rmse(w, list(MODELS), "y", weights)
    return spark.createDataFrame([(m, v, rmse) for m, v in weights.items()], "model string, weight double, rmse double")


def _base_models():
    return {"ridge": mo.linear_factory("ridge", 10.0), "lasso": mo.linear_factory("lasso", 1e-3),
            "rf": lambda: mo.make_tree("rf", **RF)}


@register("k05_oof_predictions")
def k05_oof_predictions(spark, d):
    train, test = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS).select("okey", "fold", "features", "label")
    oof, tst = ens.oof_predictions(data, _base_models(), "okey", "fold", mo.assemble(test, MODEL_FEATS))
    return oof.select(F.lit("oof").alias("part"), "*").unionByName(tst.select(F.lit("test").alias("part"), "*"))


@register("k06_cached_oof")
def k06_cached_oof(spark, d):
    train, _ = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS)
    fp = ens.input_fingerprint(train.select("okey", "fold", "y", *MODEL_FEATS), "ridge", "10.0")
    path = scratch_path(spark, "oof")
    first = ens.cached_oof(spark, path, fp, lambda: ens.oof_predictions(data, {"ridge": mo.linear_factory("ridge", 10.0)},
                                                                        "okey", "fold")[0])
    again = ens.cached_oof(spark, path, fp, lambda: (_ for _ in ()).throw(RuntimeError("cache miss")))
    return again.join(first.select("okey"), "okey", "left_semi")


@register("k07_stacking_meta")
def k07_stacking_meta(spark, d):
    train, test = model_frame(spark, d)
    data = mo.assemble(train, MODEL_FEATS).select("okey", "fold", "features", "label")
    oof, tst = ens.oof_predictions(data, _base_models(), "okey", "fold", mo.assemble(test, MODEL_FEATS))
    oof = oof.join(train.select("okey", "y"), "okey")
    _, pred = ens.stack_meta(oof, tst, list(_base_models()), "y", "okey", alpha=0.1)
    return pred
