"""Cross-validation fold assignment as a ``fold`` column: I01-I05.

A fold is a column, not a list of index arrays: train = ``fold != k``,
validation = ``fold == k``.  Assignment is a deterministic function of the row
key (reproducible across engines and recomputations); NumPy's permutation
cannot be reproduced and is not attempted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.ordered import global_row_number
from plinth.functions.quantile import group_quantiles
from plinth.functions.sizing import broadcast_if_small, hold
from plinth.operators.features import col

M31 = 2147483648  # 2^31
# The linear congruential step used to scramble keys.
LCG_A = 1103515245
LCG_C = 12345


def scramble(key: Column, seed: int) -> Column:
    """Key -> pseudo-random integer in [0, 2^31) (bigint arithmetic, no overflow)."""
    return F.pmod(F.pmod(key.cast("long"), F.lit(M31)) * LCG_A + LCG_C + seed, F.lit(M31))


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Shuffled k-fold by scrambled key."""
    return df.withColumn(name, F.pmod(scramble(F.col(key), seed), F.lit(k)).cast("int"))


#: Rows of a bin that one window of the deal is meant to hold.
DEAL_ROWS = 1_000_000


def _bin_borders(df: DataFrame, key: str, target: str, size: int, n_bins: int) -> list[tuple]:
    """The (target, key) of the last row of each bin but the last, in (target, key) order, NULL targets first.

    The targets are exact order statistics.  Only where a border falls inside equal targets are these rows' keys
    (no other column) ordered to find the key.  A key of None: all rows of that target lie below the border.
    """
    t = col(target).cast("double")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count(t).alias("known"), F.count_if(F.isnan(t)).alias("nan")).first()
    missing, numbers = r["n"] - r["known"], r["known"] - r["nan"]
    ranks = [b * size for b in range(1, n_bins) if b * size <= r["n"]]
    inner = [x for x in ranks if missing < x <= missing + numbers]
    at: dict[int, float | None] = {x: None if x <= missing else math.nan for x in ranks}
    if inner:
        probs = [(x - missing - 1) / max(1, numbers - 1) for x in inner]
        for q in group_quantiles(df.where(~F.isnan(t)).select(t.alias("_t")), [], "_t", probs).collect():
            at[inner[q["p_idx"]]] = q["q"]
    # an interpolated quantile may miss its value by a rounding error: the exact value is the nearest one of the table
    if inner:
        wanted = sorted({at[x] for x in inner})
        found = df.where(~F.isnan(t)).agg(*[F.min_by(t, F.abs(t - F.lit(v))).alias(f"v{i}") for i, v in enumerate(wanted)]).first()
        exact = dict(zip(wanted, found))
        at.update({x: exact[at[x]] for x in inner})
    values = list(dict.fromkeys("nan" if v is not None and math.isnan(v) else v for v in at.values()))

    def same(v) -> Column:
        return t.isNull() if v is None else F.isnan(t) if v == "nan" else t == F.lit(v)

    def below(v) -> Column:
        return F.lit(False) if v is None else ~F.isnan(t) if v == "nan" else t.isNull() | (t < F.lit(v))

    counts = df.agg(*[F.count_if(below(v)).alias(f"b{i}") for i, v in enumerate(values)],
                    *[F.count_if(same(v)).alias(f"s{i}") for i, v in enumerate(values)]).first() if values else None
    borders = []
    for x in ranks:
        v = "nan" if at[x] is not None and math.isnan(at[x]) else at[x]
        i = values.index(v)
        inside = x - counts[f"b{i}"]  # rows of this target below the border
        borders.append([v, None if inside == counts[f"s{i}"] else inside])
    for v in values:  # at most one per border
        need = {inside for w, inside in borders if w == v and inside is not None}
        if need:
            ties = global_row_number(df.where(same(v)).select(F.col(key).alias("_k")), ["_k"], "_rn")
            keys = {r["_rn"]: r["_k"] for r in ties.where(F.col("_rn").isin(*need)).collect()}
            for b in borders:
                if b[0] == v and b[1] is not None:
                    b[1] = ("key", keys[b[1]])
    return [(v, None if k is None else k[1]) for v, k in borders]


def _deal(df: DataFrame, key: str, target: str, k: int, n_bins: int, seeds: Sequence[int], name: str, keep_bin: bool) -> DataFrame:
    """The rows once per seed with ``fold``, ``_seed_no`` and, if kept, ``_bin``.

    A row's place in its bin is the number of rows in the hash ranges before its own (counts per bin and range,
    one small aggregate) plus its place inside the range (a window of some ``DEAL_ROWS`` rows).  Whole rows are
    shuffled once, without a global sort; only the key and the target are cached, for the passes that find borders.
    """
    narrow = hold(df.select(F.col(key), col(target)))
    n = narrow.count()
    size = max(1, n // n_bins)
    t, key_col = col(target).cast("double"), F.col(key)
    binned = F.lit(0)
    for v, border in _bin_borders(narrow, key, target, size, n_bins):
        if v is None:
            above = t.isNotNull() if border is None else t.isNotNull() | (key_col > F.lit(border))
        elif v == "nan":
            above = F.lit(False) if border is None else F.isnan(t) & (key_col > F.lit(border))
        else:
            above = t > F.lit(v) if border is None else (t > F.lit(v)) | ((t == F.lit(v)) & (key_col > F.lit(border)))
        binned = binned + F.coalesce(above, F.lit(False)).cast("int")
    ranges = max(1, -(-max(size, n - size * (n_bins - 1)) // DEAL_ROWS))
    draws = F.explode(F.array(*[F.struct(F.lit(i).alias("_seed_no"), scramble(key_col, s).alias("_h")) for i, s in enumerate(seeds)]))
    rows = df.withColumn("_bin", binned).withColumn("_d", draws)
    rows = rows.select(*[F.col(f"`{c}`") for c in df.columns], "_bin", "_d._seed_no", "_d._h")
    rows = rows.withColumn("_range", F.floor(F.col("_h") * ranges / M31).cast("int"))
    place = F.row_number().over(Window.partitionBy("_seed_no", "_bin", "_range").orderBy("_h", key)).cast("long") - 1
    if ranges > 1:
        counts = rows.groupBy("_seed_no", "_bin", "_range").agg(F.count(F.lit(1)).alias("_c"))
        earlier = F.sum("_c").over(Window.partitionBy("_seed_no", "_bin").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        before = counts.select("_seed_no", "_bin", "_range", F.coalesce(earlier, F.lit(0)).alias("_before"))
        rows = rows.withColumn("_place", place).join(broadcast_if_small(before, bound=len(seeds) * n_bins * ranges), ["_seed_no", "_bin", "_range"])
        place = F.col("_place") + F.col("_before")
    rows = rows.withColumn(name, F.pmod(place, F.lit(k)).cast("int"))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if c != name], *(["_bin"] if keep_bin else []), name, "_seed_no")


def stratified_kfold(df: DataFrame, key: str, target: str, k: int = 5, n_bins: int = 10, seed: int = 42,
                     name: str = "fold", keep_bin: bool = False) -> DataFrame:
    """``n_bins`` equal-count target bins (remainder in the last), then within each
    bin the rows, shuffled by scrambled key, are dealt round-robin to ``k`` folds.

    Bins follow (target, key) order, NULL targets first, NaN last; the key must be unique, the target
    is compared as a double.
    """
    return _deal(df, key, target, k, n_bins, [seed], name, keep_bin).drop("_seed_no")


def group_kfold(df: DataFrame, group: str, k: int = 5, name: str = "fold") -> DataFrame:
    """Whole groups per fold, sizes balanced by snake order over groups sorted by
    size (desc, then name)."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    # position of each group in (size desc, name) order; the group table can itself be
    # large (one row per user, say), so no single-partition window
    r = global_row_number(sizes, [F.desc("_n"), F.col(group)], "_r1").select(group, (F.col("_r1") - 1).alias("_r"))
    lap, off = F.floor(F.col("_r") / k), F.pmod(F.col("_r"), F.lit(k))
    table = r.select(group, F.when(F.pmod(lap, F.lit(2)) == 0, off).otherwise(k - 1 - off).cast("int").alias(name))
    return df.join(broadcast_if_small(table), group, "left")


def repeated_stratified(df: DataFrame, key: str, target: str, k: int = 5, repeats: int = 3, n_bins: int = 10,
                        seed: int = 42, name: str = "fold") -> DataFrame:
    """``repeats`` stratified assignments with seeds ``seed + r``; long output with ``repeat``.
    The repeats share the bins and one shuffle."""
    seeds = [seed + r for r in range(repeats)]
    return _deal(df, key, target, k, n_bins, seeds, name, keep_bin=False).withColumnRenamed("_seed_no", "repeat")


def cv_strategy(df: DataFrame, strategy: str = "stratified", key: str = "id", target: str | None = None,
                group: str | None = None, k: int = 5, seed: int = 42, **kw) -> DataFrame:
    """Dispatcher with the reference's argument errors."""
    if k < 2:
        raise ValueError("n_splits must be at least 2")
    if strategy == "kfold":
        return kfold(df, key, k, seed)
    if strategy == "stratified":
        if target is None:
            raise ValueError("stratified CV needs a target column")
        return stratified_kfold(df, key, target, k, seed=seed, **kw)
    if strategy == "group":
        if group is None:
            raise ValueError("group CV needs a group column")
        return group_kfold(df, group, k)
    if strategy == "repeated":
        if target is None:
            raise ValueError("repeated CV needs a target column")
        return repeated_stratified(df, key, target, k, seed=seed, **kw)
    raise ValueError(f"unknown CV strategy {strategy!r}")
