"""Run-log and leaderboard analytics: A08, A09, A13, B27-B29, N01-N12.

A run log is a table ``(run_id, timestamp, model, rmse, hyperparams, ...)``
where ``run_id`` is the append order.  Per-model "latest"/"best" picks use
``max_by``/``min_by`` aggregates (map-side combined, nothing grouped into one
task); ordered comparisons (previous run, running best, nearest in time) use
the global-order helpers, never a window partitioned by the model alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.ordered import asof_nearest, previous_row, running_extreme
from plinth.functions.sizing import broadcast_if_small
from plinth.operators.features import col

# ---------------------------------------------------------------- B27
# The reference's file-name -> model-name map, in its order.
MODEL_NAME_MAP = {
    "catboost_model": "catboost",
    "xgboost_model": "xgboost",
    "lightgbm_model": "lightgbm",
    "ridge_model_kfold": "ridge",
    "lasso_model_kfold": "lasso",
    "elasticnet_model": "elastic_net",
    "randomforest_model": "random_forest",
    "svr_model": "svr",
    "blend_xgb_lgb_cat_model": "blending",
    "stacking_submission": "STACKING_META",
    "naive_lr": "linear_regression",
}


def normalize_model_name(c: Column, mapping: Mapping[str, str] = MODEL_NAME_MAP) -> Column:
    """Lower-case, drop ``.csv``; exact map hit, else the FIRST key contained in the
    name (map order), else the name itself."""
    name = F.lower(F.replace(c, F.lit(".csv"), F.lit("")))
    out = name
    for k, v in reversed(list(mapping.items())):
        out = F.when(F.contains(name, F.lit(k)), F.lit(v)).otherwise(out)
    for k, v in mapping.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out


def strip_numeric_prefix(c: Column) -> Column:
    """B27 variant: ``7_xgboost`` -> ``xgboost``."""
    return F.regexp_replace(c, r"^\d+_", "")


# ---------------------------------------------------------------- B28
def format_runtime(seconds: Column) -> Column:
    """``Xh Ym Zs`` / ``Ym Zs`` / ``Zs``; at >= 1 h with 0 minutes the minutes are omitted."""
    s = seconds.cast("double")
    h = F.floor(s / 3600).cast("long")
    m = F.floor(F.pmod(s, F.lit(3600.0)) / 60).cast("long")
    sec = F.floor(F.pmod(s, F.lit(60.0))).cast("long")
    return (F.when(s.isNull(), F.lit(""))
            .when(s >= 3600, F.when(m > 0, F.format_string("%dh %dm %ds", h, m, sec))
                  .otherwise(F.format_string("%dh %ds", h, sec)))
            .when(s >= 60, F.format_string("%dm %ds", F.floor(s / 60).cast("long"), sec))
            .otherwise(F.format_string("%ds", F.floor(s).cast("long"))))


# ---------------------------------------------------------------- B29
def explode_hyperparams(df: DataFrame, json_col: str, keep: Sequence[str]) -> DataFrame:
    """JSON object text -> one row per ``(key, value)``; unparsable text yields no rows."""
    parsed = F.from_json(col(json_col), "map<string,string>")
    return df.select(*[col(k) for k in keep], F.explode_outer(parsed).alias("param", "value")).where(
        F.col("param").isNotNull())


# ---------------------------------------------------------------- A13
def feature_hash(features: Column) -> Column:
    """First 8 hex chars of md5 of the JSON list of sorted names (Python ``json.dumps``
    spacing: ``["a", "b"]``)."""
    arr = F.array_sort(features)
    quoted = F.transform(arr, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    text = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    return F.substring(F.md5(text), 1, 8)


# ---------------------------------------------------------------- A08/A09
DEDUP_KEYS = ("model", "rmse", "hyperparams", "feat_hash")
#: Decimal places to which a key is compared.
KEY_PLACES = {"rmse": 6}


def _key(name: str):
    return F.round(col(name), KEY_PLACES[name]) if name in KEY_PLACES else col(name)


def fresh_runs(log: DataFrame, new: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order: str = "run_id") -> DataFrame:
    """A08 core: the runs of ``new`` whose keys are not in ``log`` (left-anti join, NULL-safe);
    among new runs sharing keys only the first (lowest ``order``) is kept -- the same result
    as appending them one at a time.  The within-batch pick is a ``min_by`` aggregate."""
    keys = [k for k in keys if k in log.columns and k in new.columns]
    cond = None
    for k in keys:
        e = _key(k).eqNullSafe(F.col(f"_log_{k}"))
        cond = e if cond is None else cond & e
    logged = log.select(*[_key(k).alias(f"_log_{k}") for k in keys])
    fresh = new.join(logged, cond, "left_anti") if cond is not None else new
    if keys and order in fresh.columns:
        firsts = fresh.groupBy(*[_key(k).alias(f"_k_{k}") for k in keys]).agg(
            F.min_by(F.struct(*[col(c) for c in fresh.columns]), col(order)).alias("_r"))
        fresh = firsts.select("_r.*")
    return fresh


def append_runs(log: DataFrame, new: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order: str = "run_id") -> DataFrame:
    """Append runs not already logged (see :func:`fresh_runs`), adding missing columns
    on either side."""
    return log.unionByName(fresh_runs(log, new, keys, order), allowMissingColumns=True)


def set_latest_score(log: DataFrame, model: str, score: float, order: str = "run_id",
                     score_col: str = "kaggle_score") -> DataFrame:
    """Set ``score_col`` on the latest row (by ``order``) of ``model``."""
    latest_id = log.where(F.col("model") == model).agg(F.max(col(order)).alias("_latest")).first()["_latest"]
    hit = (F.col("model") == model) & (col(order) == F.lit(latest_id))
    base = col(score_col) if score_col in log.columns else F.lit(None).cast("double")
    return log.withColumn(score_col, F.when(hit, F.lit(float(score))).otherwise(base))


# ---------------------------------------------------------------- N01
def best_per_model(log: DataFrame, metric: str = "rmse", order: str = "run_id",
                   cols: Sequence[str] = ("run_id", "timestamp")) -> DataFrame:
    """The run with the lowest metric per model (ties: earliest logged), sorted by metric."""
    key = F.struct(col(metric), col(order))
    pick = F.min_by(F.struct(*[col(c) for c in cols]), key)
    out = log.where(col(metric).isNotNull()).groupBy("model").agg(F.min(col(metric)).alias(f"best_{metric}"),
                                                                   pick.alias("_b"), F.count(F.lit(1)).alias("runs"))
    return out.select("model", f"best_{metric}", "runs", *[F.col(f"_b.{c}").alias(c) for c in cols])


# ---------------------------------------------------------------- N02
def latest_non_null(log: DataFrame, cols: Sequence[str], by: str = "model", order: str = "run_id") -> DataFrame:
    """Pandas ``groupby().last()``: per column, the last NON-NULL value in log order."""
    aggs = [F.max_by(col(c), F.when(col(c).isNotNull(), col(order))).alias(c) for c in cols]
    return log.groupBy(col(by)).agg(*aggs)


# ---------------------------------------------------------------- N03
def top_runs(log: DataFrame, metric: str, n: int = 10, max_valid: float | None = 1.0,
             order: str = "run_id") -> DataFrame:
    """The ``n`` best runs by ``metric`` (valid runs only), ties by log order."""
    valid = log.where(col(metric).isNotNull())
    if max_valid is not None:
        valid = valid.where(col(metric) < max_valid)
    return valid.orderBy(col(metric), col(order)).limit(n)


# ---------------------------------------------------------------- N04
def latest_feature_sets(log: DataFrame, hash_col: str = "feat_hash", n: int = 3, ts: str = "timestamp",
                        order: str = "run_id") -> DataFrame:
    """The ``n`` most recently used feature sets with their last use and run count."""
    per = log.groupBy(col(hash_col)).agg(F.max(col(ts)).alias("last_used"), F.max(col(order)).alias("_last"),
                                         F.count(F.lit(1)).alias("runs"))
    return per.orderBy(F.desc("last_used"), F.desc("_last")).limit(n).drop("_last")


def history_newest_first(log: DataFrame, ts: str = "timestamp", order: str = "run_id") -> DataFrame:
    """The whole history newest first (a range-partitioned global sort)."""
    return log.orderBy(F.desc(col(ts)), F.desc(col(order)))


# ---------------------------------------------------------------- N05
def hyperparams_of_scored(log: DataFrame, score: str = "kaggle_score", json_col: str = "hyperparams") -> DataFrame:
    """Per scored run, its hyperparameters as ``(model, run_id, param, value)``."""
    scored = log.where(col(score).isNotNull())
    return explode_hyperparams(scored, json_col, ["model", "run_id", score])


# ---------------------------------------------------------------- N06
def change_vs_previous(log: DataFrame, metric: str = "rmse", features: str = "features",
                       order: Sequence[str] = ("timestamp", "run_id"), tol: float = 1e-6) -> DataFrame:
    """Per run, the difference to the previous run of the same model, the trend
    (IMPROVED / WORSE / NO CHANGE) and feature-set changes (added / removed names)."""
    hashed = log.withColumn("_fh", feature_hash(col(features)))
    p = previous_row(hashed, ["model"], [F.col(o) for o in order], [metric, features, "_fh"])
    diff = col(metric) - F.col(f"prev_{metric}")
    trend = (F.when(F.col(f"prev_{metric}").isNull(), F.lit(None))
             .when(F.abs(diff) < tol, F.lit("NO CHANGE")).when(diff < 0, F.lit("IMPROVED")).otherwise(F.lit("WORSE")))
    fc = F.when(F.col("prev__fh").isNull(), F.lit(None)).when(F.col("prev__fh") == F.col("_fh"), F.lit("IDENTICAL")) \
        .otherwise(F.lit("CHANGED"))
    added = F.array_sort(F.array_except(col(features), F.col(f"prev_{features}")))
    removed = F.array_sort(F.array_except(F.col(f"prev_{features}"), col(features)))
    return p.select("run_id", "model", diff.alias("diff"), trend.alias("trend"), fc.alias("feature_set"),
                    F.when(F.col(f"prev_{features}").isNotNull(), added).alias("added"),
                    F.when(F.col(f"prev_{features}").isNotNull(), removed).alias("removed"))


# ---------------------------------------------------------------- N07
# The reference's fallback names for models without runs of their own.
MODEL_ALIASES = {"STACKING_META": "stacking", "blending": "blend"}


def attach_nearest_scores(runs: DataFrame, subs: DataFrame, score: str = "score", ts: str = "timestamp",
                          run_id: str = "run_id", sub_id: str = "sub_id", score_col: str = "kaggle_score",
                          aliases: Mapping[str, str] = MODEL_ALIASES, **kw) -> DataFrame:
    """Each submission's score goes to the run of the same model nearest in time (a
    model without runs is looked up under its alias); when several submissions hit one
    run, the last one in log order wins; unchanged scores are left alone.  Returns
    ``runs`` with ``score_col`` (and ``matched_sub``)."""
    subs = subs.where(col(score).isNotNull())  # a submission without a score has nothing to give
    if aliases:
        logged = runs.select("model").distinct()  # one row per model
        hit = subs.join(logged.withColumn("_has", F.lit(True)), "model", "left")
        alias = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))])
        subs = hit.withColumn("model", F.when(F.col("_has").isNull(), F.coalesce(alias[F.col("model")], F.col("model")))
                              .otherwise(F.col("model"))).drop("_has")
    m = asof_nearest(runs, subs, ["model"], ts, run_id, sub_id, **kw)
    m = m.where(F.col(run_id).isNotNull()).join(subs.select(col(sub_id), col(score)), sub_id)
    winner = m.groupBy(run_id).agg(F.max_by(F.struct(col(score).alias("s"), col(sub_id).alias("i")), col(sub_id)).alias("_w"))
    j = runs.join(winner, run_id, "left")
    old = col(score_col) if score_col in runs.columns else F.lit(None).cast("double")
    new = F.col("_w.s")
    changed = new.isNotNull() & (old.isNull() | (old != new))
    keep = [col(c) for c in runs.columns if c != score_col]
    return j.select(*keep, F.when(changed, F.round(new, 6)).otherwise(old).alias(score_col),
                    F.when(changed, F.col("_w.i")).alias("matched_sub"))


# ---------------------------------------------------------------- N08
def average_rank(df: DataFrame, metric: str, by: str = "model", name: str = "rank") -> DataFrame:
    """Average rank of ``metric`` (ties share the mean rank, like ``rank(method='average')``).

    min rank = 1 + rows with a smaller value; computed from the value-count table
    with a range-partitioned prefix sum, not a single-partition window.
    """
    counts = df.groupBy(col(metric)).agg(F.count(F.lit(1)).alias("_k"))
    ranked = running_sum_before(counts, metric, "_k", "_below")
    avg_rank = F.col("_below") + (F.col("_k") + 1) / 2.0
    return df.join(ranked.select(metric, avg_rank.alias(name)), metric, "left")


def running_sum_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows earlier in ``order`` (unique order column)."""
    from plinth.functions.ordered import global_row_number
    from pyspark.sql import Window
    r = global_row_number(df, [F.col(order)], "_rn")
    chunk = F.floor((F.col("_rn") - 1) / 1_000_000).cast("long")
    r = r.withColumn("_chunk", chunk)
    w = Window.partitionBy("_chunk").orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_within", F.coalesce(F.sum(value).over(w), F.lit(0)))
    per = r.groupBy("_chunk").agg(F.sum(value).alias("_cs"))
    carry = per.select("_chunk", F.coalesce(F.sum("_cs").over(
        Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carry"))
    j = r.join(broadcast_if_small(carry), "_chunk", "left")
    return j.withColumn(name, F.col("_within") + F.col("_carry")).drop("_within", "_carry", "_chunk", "_rn")


# ---------------------------------------------------------------- N09
def rank_and_quantile(board: DataFrame, score: str = "score", higher_is_better: bool = False) -> DataFrame:
    """Leaderboard rank (1 = best, ties share the best rank) and quantile
    ``(1 - (rank - 1) / n) * 100``."""
    counts = board.groupBy(col(score)).agg(F.count(F.lit(1)).alias("_k"))
    if higher_is_better:
        counts = counts.withColumn("_o", -col(score))
    else:
        counts = counts.withColumn("_o", col(score))
    ranked = running_sum_before(counts, "_o", "_k", "_better")
    n = board.count()
    rank = (F.col("_better") + 1).cast("long")
    q = (F.lit(1.0) - (rank - 1) / F.lit(float(n))) * 100
    return board.join(ranked.select(score, rank.alias("rank"), q.alias("quantile")), score, "left")


def _plain(name):
    return F.regexp_replace(F.lower(F.trim(name)), "[ _]", "")


def match_to_leaderboard(mine: DataFrame, board: DataFrame, name_col: str = "name", score: str = "score",
                         tol: float = 1e-4) -> DataFrame:
    """Match by name first (letter case, spaces and underscores don't count), else by the board
    entry with the nearest score within ``tol`` (of equally near ones the better rank).  ``board`` must
    carry ``rank`` (see rank_and_quantile).  One row per row of ``mine``, equal rows included."""
    names = board.groupBy(_plain(col(name_col)).alias("_bn")).agg(F.min("rank").alias("_rank_name"))
    # a value row is matched once however many rows have it
    scores = mine.select(col(score).alias("_ms")).where("_ms IS NOT NULL").distinct()
    ranked = board.groupBy(col(score).alias("_bs")).agg(F.min("rank").alias("_r")) \
        .withColumn("_bk", F.floor(F.col("_bs") / tol).cast("long"))
    # a banded equi-join: buckets of width ``tol``, each score probes its bucket and both
    # neighbours, so no pair outside the band is ever formed
    probe = scores.withColumn("_bk", F.explode(F.array(*[F.floor(F.col("_ms") / tol).cast("long") + d for d in (-1, 0, 1)])))
    gap = F.abs(F.col("_ms") - F.col("_bs"))
    near = probe.join(ranked, "_bk").where(gap <= tol) \
        .groupBy("_ms").agg(F.min(F.struct(gap.alias("gap"), F.col("_r").alias("r"))).alias("_near"))
    out = mine.join(names, _plain(mine[name_col]) == F.col("_bn"), "left") \
        .join(near, mine[score] == F.col("_ms"), "left")
    return out.select(*[mine[c] for c in mine.columns], F.coalesce("_rank_name", "_near.r").alias("rank"))


# ---------------------------------------------------------------- N10
def score_distribution(board: DataFrame, score: str = "score", own: float | None = None,
                       cutoffs: Sequence[float] = (0.01, 0.05, 0.10, 0.25, 0.50)) -> DataFrame:
    """N, min, max, median, mean, own percentile and the score needed for the top
    1/5/10/25/50 % (exact quantiles, lower score is better)."""
    from plinth.functions.quantile import group_quantiles
    probs = [0.5, *cutoffs]
    got = {r["p_idx"]: r["q"] for r in group_quantiles(board, [], score, probs).collect()}  # len(probs) values
    names = ["median", *[f"top_{int(round(c * 100))}pct" for c in cutoffs]]
    base = board.agg(F.count(col(score)).alias("n"), F.min(col(score)).alias("min"), F.max(col(score)).alias("max"),
                     F.avg(col(score)).alias("mean"),
                     *([F.avg(F.when(col(score) > own, 1.0).otherwise(0.0)).alias("own_percentile")] if own is not None else []))
    return base.select("*", *[F.lit(got.get(i)).cast("double").alias(n) for i, n in enumerate(names)])


# ---------------------------------------------------------------- N11
def daily_quota(subs: DataFrame, ts: str = "timestamp", quota: int = 10) -> DataFrame:
    """Submissions per day against the daily quota."""
    per = subs.groupBy(F.to_date(col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("submitted"))
    return per.withColumn("remaining", F.greatest(F.lit(quota) - F.col("submitted"), F.lit(0))) \
        .withColumn("quota_reached", F.col("submitted") >= quota)


def pending_split(candidates: DataFrame, submitted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Candidates already submitted (left-semi) vs pending (left-anti)."""
    return candidates.join(submitted.select(key), key, "left_semi"), candidates.join(submitted.select(key), key, "left_anti")


# ---------------------------------------------------------------- N12
def previous_best(subs: DataFrame, score: str = "score", order: Sequence[str] = ("timestamp", "sub_id"),
                  **kw) -> DataFrame:
    """The best (lowest) score among all earlier submissions and the improvement on it."""
    r = running_extreme(subs, [], [F.col(o) for o in order], score, "min", inclusive=False, name="previous_best", **kw)
    imp = F.when(col(score) < F.col("previous_best"), F.col("previous_best") - col(score))
    status = (F.when(F.col("previous_best").isNull(), F.lit(None))
              .when(col(score) < F.col("previous_best"), F.lit("IMPROVEMENT"))
              .when(col(score) > F.col("previous_best"), F.lit("WORSE")).otherwise(F.lit("SAME")))
    return r.withColumn("improvement", imp).withColumn("status", status)
