"""Out-of-fold target encoding (stage 8): H01-H05.

No per-fold loop: one ``groupBy(category, fold)`` gives per-fold sums and
counts; subtracting a fold's share from the category total gives the
statistics of the other folds.  The small ``(category, fold)`` table is joined
back on both keys; several columns share one grouping-sets aggregate.  Out-of-fold medians
take the ranks of the other folds' rows from counts per (group, fold, cell), so no row is copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.quantile import complement_quantiles, global_quantiles
from plinth.functions.sizing import broadcast_if_small, hold
from plinth.operators.features import col, with_columns
from plinth.operators.shape import norm_ppf


def oof_target_encode(train: DataFrame, test: DataFrame, cat: str, target: str, fold: str = "fold",
                      smoothing: float = 1.0, noise_level: float = 0.0, seed: int = 42,
                      name: str | None = None, key: str | None = None,
                      sums: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Smoothed out-of-fold mean ``(sum + g*m) / (n + m)``; unseen -> global mean ``g``.

    Train rows get the statistics of the other folds (plus optional Gaussian noise
    with sd ``noise_level * std`` of the fold's encoded values; it derives from a hash of the
    row's ``key`` (without one: all its columns), its fold and ``seed``, so a recomputed or
    repartitioned row gets the same noise);
    test rows get the full-train statistics and no noise.  ``sums``: the category's (cat, fold, _s, _c), where
    the caller has them.
    """
    name = name or f"{cat}_TargetEnc"
    per = hold(category_sums(train, [cat], target, fold)[cat]) if sums is None else sums
    full = per.groupBy(col(cat)).agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    g = per.agg(F.try_divide(F.sum("_s"), F.sum("_c"))).first()[0]
    w = Window.partitionBy(col(cat))  # at most k rows per category
    per = per.select(cat, fold, (F.sum("_s").over(w) - F.col("_s")).alias("_so"),
                     (F.sum("_c").over(w) - F.col("_c")).alias("_co"))
    j = train.join(broadcast_if_small(per), [cat, fold], "left")
    enc = F.when(F.col("_co") > 0, (F.col("_so") + F.lit(g * smoothing)) / (F.col("_co") + F.lit(smoothing))) \
        .otherwise(F.lit(g))
    tr = with_columns(j, [(name, enc)]).drop("_so", "_co")
    if noise_level > 0:
        sd = tr.groupBy(fold).agg(F.stddev_samp(col(name)).alias("_sd"))
        tr = tr.join(broadcast_if_small(sd), fold, "left")
        row = F.xxhash64(*([col(key)] if key else [col(c) for c in train.columns]), col(fold), F.lit(seed))
        noise = norm_ppf((F.pmod(row, F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))) * F.lit(noise_level) * F.coalesce(F.col("_sd"), F.lit(0.0))
        tr = with_columns(tr, [(name, col(name) + noise)]).drop("_sd")

    tj = test.join(broadcast_if_small(full), cat, "left")
    tenc = F.coalesce((F.col("_s") + F.lit(g * smoothing)) / (F.col("_c") + F.lit(smoothing)), F.lit(g))
    te = with_columns(tj, [(name, tenc)]).drop("_s", "_c")
    return tr, te


def category_sums(train: DataFrame, cats: Sequence[str], target: str, fold: str = "fold") -> dict[str, DataFrame]:
    """(cat, fold, _s, _c) of each category column, all from one grouping-sets aggregate."""
    sets = [[col(c), col(fold)] for c in cats]
    y = F.col("_y").cast("double")
    rows = train.select(*[col(c) for c in dict.fromkeys([*cats, fold])], col(target).alias("_y"))
    # which set a row is of: the grouping id has a bit for every column that is not in it
    all_sums = rows.groupingSets(sets, *[col(c) for c in cats], col(fold)).agg(
        F.grouping_id().alias("_set"), F.sum(y).alias("_s"), F.count(y).alias("_c"))
    all_sums = hold(all_sums) if len(cats) > 1 else all_sums
    n = len(cats)
    bits = (1 << n) - 1
    return {c: all_sums.where(F.col("_set") == (bits ^ (1 << (n - 1 - i))) << 1).select(col(c), col(fold), "_s", "_c") for i, c in enumerate(cats)}


def encode_many(train: DataFrame, test: DataFrame, cats: Sequence[str], target: str, fold: str = "fold",
                **kw) -> tuple[DataFrame, DataFrame]:
    """:func:`oof_target_encode` for each present column, ``<col>_TargetEnc``; all sums come from one aggregate
    over the columns as they are given."""
    cats = [c for c in dict.fromkeys(cats) if c in train.columns and c in test.columns]
    if not cats:
        return train, test
    sums = category_sums(train, cats, target, fold)
    for c in cats:
        train, test = oof_target_encode(train, test, c, target, fold, sums=sums[c], **kw)
    return train, test


STATS = ("mean", "median", "std", "min", "max")


def oof_group_stats(train: DataFrame, test: DataFrame, group: str, target: str, k: int, fold: str = "fold",
                    prefix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold mean/median/std/min/max of ``target`` per ``group``.

    One aggregate per (group, fold) gives counts, means, squared deviations and extremes; those of the other folds
    are merged on that small table.  Medians come from :func:`complement_quantiles` for all folds and the whole
    group at once.  No row is copied.  Fallbacks: NULL std -> global std; unseen group -> global mean (mean),
    global median (median), global std (std, min and max -- the reference's rule).  ``k`` is the number of folds.
    """
    prefix = prefix or group
    names = {s: f"{prefix}_{s}_{target}" for s in STATS}
    y = F.col("_t")
    rows = train.select(col(group).alias("_g"), col(fold).alias("_f"), col(target).cast("double").alias("_t")).where(y.isNotNull())
    base = hold(rows.groupBy("_g", "_f").agg(F.count(y).alias("n"), F.avg(y).alias("m"), (F.var_pop(y) * F.count(y)).alias("m2"),
                                             F.min(y).alias("lo"), F.max(y).alias("hi")))
    glob = _merged(base, []).first()
    g_median, = global_quantiles(rows, "_t", [0.5])
    g = {"mean": glob["mean"], "median": g_median, "std": glob["std"], "min": glob["std"], "max": glob["std"]}
    mid = complement_quantiles(rows, ["_g"], "_f", "_t", [0.5]).withColumnRenamed("q", "median")
    known = base.where("_g is not null")
    left = known.select("_g", F.col("_f").alias("_slot")).join(known, "_g").where(~F.col("_slot").eqNullSafe(F.col("_f")))
    per_fold = _merged(left, ["_g", "_slot"]).join(mid.where("not whole").select("_g", F.col("_f").alias("_slot"), "median"), ["_g", "_slot"], "left")
    full = _merged(known, ["_g"]).join(mid.where("whole").select("_g", "median"), "_g", "left")
    std = F.coalesce("std", F.lit(g["std"]).cast("double")).alias("std")
    out = lambda df, *more: df.withColumn("std", std).select(F.col("_g").alias(group), *more, *[F.col(s).alias(names[s]) for s in STATS])
    fill = [(names[s], F.coalesce(col(names[s]), F.lit(g[s]))) for s in STATS]
    tr = with_columns(train.join(broadcast_if_small(out(per_fold, F.col("_slot").alias(fold))), [group, fold], "left"), fill)
    te = with_columns(test.join(broadcast_if_small(out(full)), group, "left"), fill)
    return tr, te


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, mean, std, min, max) of the rows behind (n, m, m2, lo, hi); a key has one row a fold, so windows are small."""
    whole = Window.partitionBy(*keys) if keys else None
    if whole is None:  # all groups: the shared mean first, then the deviations from it
        c = parts.agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n"))).first()[0]
        parts = parts.withColumn("_mean", F.lit(c).cast("double"))
    else:
        parts = parts.withColumn("_mean", F.sum(F.col("n") * F.col("m")).over(whole) / F.sum("n").over(whole))
    d = F.col("m") - F.col("_mean")
    got = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * d * d).alias("m2"),
                                   F.min("lo").alias("min"), F.max("hi").alias("max"))
    return got.select(*keys, "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"), "min", "max")


def ratio_target_encode(train: DataFrame, test: DataFrame, group: str, target: str, size: str,
                        fold: str = "fold", **kw) -> tuple[DataFrame, DataFrame]:
    """Encode ``target / (size + 1)`` by ``group`` (temporary column dropped)."""
    tmp = "_ratio_target"
    tr = with_columns(train, [(tmp, col(target) / (col(size) + 1))])
    name = kw.pop("name", f"{group}_PricePerSF_TargetEnc")
    tr, te = oof_target_encode(tr, test, group, tmp, fold, name=name, **kw)
    return tr.drop(tmp), te


def stat_interactions(df: DataFrame, stat_col: str, pairs: dict[str, str]) -> DataFrame:
    """``stat_col * x`` for each ``name -> x`` whose input exists."""
    specs = [(n, col(stat_col) * col(x)) for n, x in pairs.items() if stat_col in df.columns and x in df.columns]
    return with_columns(df, specs)
