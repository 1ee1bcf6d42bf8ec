"""Exact per-group quantiles (``percentile_cont`` semantics) that scale to hot groups.

Spark's exact ``percentile``/``median`` keeps every distinct value of a group in
one aggregation buffer, so a group holding a third of a 100 TB table would land
in a single task.  Here mergeable sketches guide an exact selection over the *ordered
integer image* of the doubles (``image``):

1. one pass gives every group's row count and KLL sketch (map-side combined); quantiles of the sketch on a fixed
   grid bracket every wanted rank by twice its rank error to either side.  A group of at most ``k`` rows is one bracket;
2. one more pass counts each group's rows by cell -- below, on, between and above the ends of its
   brackets -- and collects the values strictly inside the brackets only.  Values that many rows share are ends of
   brackets and are counted, not collected, so what is collected is at most ``10 * error`` of a group.  A running
   sum over the few cells finds each rank's cell, and the rank is read off;
3. where ``10 * error`` of a group is more than ``leaf_rows`` values, a pass sketches the insides instead of collecting
   them and narrows the brackets by that factor first.  With the default ``k`` that is beyond some 20 million rows
   in one group; a pass for each further factor of 80.

A rank that its bracket misses (the sketch's error is exceeded with a probability below one in a million) lies in one of the other
cells, which the next pass refines, so the result is exact in any case.

*Complements.*  Out-of-fold quantiles take the same passes: counts and sketches are kept per (group, part); the
sketches of all other parts are merged, and a cell's count for the rows outside a part is the sum over
the other parts.  No row is copied.

Every step is a DataFrame aggregate or a null-safe join against a parameter table
whose size is known before it is broadcast; NULL keys are a group like any other.
Beyond ``SORT_THRESHOLD`` probabilities one range-partitioned sort is used instead,
because every row would be held against too many brackets; the tests hold both
ways and several limits against each other.  The result equals linear
interpolation between the two neighbouring order statistics, like DuckDB's
``quantile_cont`` and Spark's ``percentile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.sizing import broadcast_if_small, hold
from plinth.session import ensure_checkpoint_dir

_G = "_qgrp"

# Above this many probabilities one global sort is used instead of selection
# (every row is held against all brackets of its group).
SORT_THRESHOLD = 64

#: Size of the sketches; a sketch of a large group takes some 100 kB.
SKETCH_K = 4096


def rank_error(k: int) -> float:
    """The published rank error (99 %) of a KLL sketch of size ``k``, as a share of its rows."""
    return 2.296 / k**0.9021


def margins(k: int) -> tuple[int, int]:
    """By how many steps of the grid a bracket reaches below and above its rank."""
    steps = math.ceil(2 * rank_error(k) * grid_steps(k))
    return -steps, steps + 1


def grid_steps(k: int) -> int:
    return math.ceil(1 / rank_error(k))


_MANTISSA = 2**52


def image(x: Column) -> Column:
    """A long in the order of the doubles: sign, exponent and mantissa as in IEEE 754, negated below zero.

    Equal doubles have equal images and only they (-0.0 equals 0.0).  Powers of two and divisions by
    them are exact, so the expression needs no access to the bits.
    """
    a = F.abs(x)
    guess = F.floor(F.log2(a))
    # log2 rounds near powers of two
    e = guess + F.when(F.pow(F.lit(2.0), guess) > a, -1).when(F.pow(F.lit(2.0), guess + 1) <= a, 1).otherwise(0)
    e = F.greatest(F.least(e, F.lit(1023)), F.lit(-1022)).cast("long")
    scale = F.pow(F.lit(2.0), e)
    normal = (e + 1023) * F.lit(_MANTISSA) + ((a / scale - 1) * F.lit(float(_MANTISSA))).cast("long")
    tiny = (a / F.lit(2.0**-1074)).cast("long")
    size = (F.when(a == float("inf"), F.lit(2047 * _MANTISSA)).when(a < F.lit(2.0**-1022), tiny).otherwise(normal))
    return F.when(x < 0, -size).otherwise(size)


def value_of(i: Column) -> Column:
    """The double with the image ``i``."""
    a = F.abs(i)
    e, m = F.shiftright(a, 52), F.pmod(a, F.lit(_MANTISSA))
    normal = (F.lit(1.0) + m / F.lit(float(_MANTISSA))) * F.pow(F.lit(2.0), F.greatest(F.least(e, F.lit(2046)), F.lit(1)) - 1023)
    x = F.when(e == 2047, F.lit(float("inf"))).when(e == 0, m * F.lit(2.0**-1074)).otherwise(normal)
    return F.when(i < 0, -x).otherwise(x)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys``; the keys of ``left`` stay."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def _hold(df: DataFrame, held: list[DataFrame], *aggs, checkpoint: bool = False) -> tuple[DataFrame, tuple]:
    """Persist a small table and compute a few aggregates over it.  With ``checkpoint`` it is
    written to the reliable checkpoint folder first (flat lineage for the rounds that follow)."""
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    held.append(df)
    return df, tuple(df.agg(*aggs).first())


def _prepare(df: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, list[str]]:
    keys = list(keys)
    x = F.col(value).cast("double")
    data = df.select(*[F.col(k) for k in keys], x.alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    if not keys:
        data = data.withColumn(_G, F.lit(0))
        keys = [_G]
    return data, keys


def _targets(stats: DataFrame, keys: Sequence[str], probs: Sequence[float], *extra: str) -> DataFrame:
    """One row per group and probability with the two ranks it lies between."""
    parr = F.array(*[F.lit(float(p)) for p in probs])
    return (stats.select(*keys, "_n", *extra, F.posexplode(parr).alias("p_idx", "p"))
            .withColumn("_h", F.col("p") * (F.col("_n") - 1))
            .withColumn("_r0", F.floor("_h").cast("long"))
            .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_n") - 1)))


def _interpolated() -> Column:
    """The value between ``_v0`` and ``_v1`` at ``_h``; without overflow, and infinite only where a value is."""
    f, v0, v1 = F.col("_h") - F.col("_r0"), F.col("_v0"), F.col("_v1")
    gap = v1 - v0
    return F.when((f == 0) | (v0 == v1), v0).when(F.abs(gap) == float("inf"), v0 * (1 - f) + v1 * f).otherwise(v0 + f * gap)


class _Selection:
    """Exact order statistics of groups, or of what is left of a group without one of its parts.

    ``data`` has the keys, ``_p`` (the part) and ``_i`` (the image).  A slot is what a rank is taken of: all
    rows of a group (``_all``) or those outside part ``_s``.  State, one row a rank: the image range [_lo, _hi]
    of its cell, the rows of the slot below it (``_below``) and in it (``_cnt``), and their sketch.
    """

    def __init__(self, data: DataFrame, keys: Sequence[str], parts: bool, k: int, leaf_rows: int, passes: list | None):
        self.data, self.keys, self.parts, self.k, self.leaf_rows = data, list(keys), parts, k, leaf_rows
        self.slot = [*self.keys, "_all", "_s"]
        self.passes = passes if passes is not None else []
        self.held: list[DataFrame] = []

    def _by_slot(self, rows: DataFrame) -> DataFrame:
        """Rows of (keys, _p, ...) once for every slot of the group that they count for: small tables only."""
        if not self.parts:
            return rows.withColumns({"_all": F.lit(True), "_s": F.lit(None).cast(dict(rows.dtypes)["_p"])}).drop("_p")
        joined = _same(rows, self.slots, self.keys)
        return joined.where(F.col("_all") | ~F.col("_p").eqNullSafe(F.col("_s"))).drop("_p")

    def groups(self) -> DataFrame:
        """Pass 1: (slot, _n, _lo, _hi, _sketch)."""
        self.passes.append("sketch")
        base = self.data.groupBy(*self.keys, "_p").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_lo"), F.max("_i").alias("_hi"), F.kll_sketch_agg_bigint("_i", F.lit(self.k)).alias("_sketch"))
        if self.parts:
            base, _ = _hold(base, self.held, F.count(F.lit(1)))
            self.slots = base.select(*self.keys, F.lit(False).alias("_all"), F.col("_p").alias("_s")).unionByName(
                base.select(*self.keys, F.lit(True).alias("_all"), F.lit(None).cast(dict(base.dtypes)["_p"]).alias("_s")).distinct())
        rows = self._by_slot(base)
        if self.parts:
            rows = rows.groupBy(*self.slot).agg(F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
                                                F.kll_merge_agg_bigint("_sketch", F.lit(self.k)).alias("_sketch"))
        return rows.select(*self.slot, "_n", "_lo", "_hi", "_sketch")

    def _brackets(self, todo: DataFrame, sketched: bool) -> DataFrame:
        """(keys, _cuts, _in): the sorted ends of a group's brackets, and for the gap after each number of ends whether it is inside one."""
        n, (down, up) = grid_steps(self.k), margins(self.k)
        if sketched:
            places = F.expr(f"array({', '.join(f'{i / n!r}D' for i in range(n + 1))})")
            grid = F.when(F.col("_cnt") > self.k, F.kll_sketch_get_quantile_bigint("_sketch", places))  # without a sketch: null
        else:
            grid = F.lit(None).cast("array<bigint>")
        todo = todo.withColumn("_grid", grid)
        step = F.floor((F.col("_rank") - F.col("_below") + 0.5) / F.col("_cnt") * n).cast("int")
        at = lambda by: F.get("_grid", F.greatest(F.lit(0), F.least(F.lit(n), step + by)))
        ends = todo.select(*self.keys, F.struct(F.coalesce(at(down), "_lo").alias("a"), F.coalesce(at(up), "_hi").alias("b")).alias("_e"))
        per = ends.groupBy(*self.keys).agg(F.collect_set("_e").alias("_e"))  # at most two a probability and slot
        per = per.withColumn("_cuts", F.array_sort(F.array_distinct(F.flatten(F.transform("_e", lambda e: F.array(e["a"], e["b"]))))))
        inside = F.transform("_cuts", lambda c: F.exists("_e", lambda e: (e["a"] <= c) & (c < e["b"])))
        return per.select(*self.keys, "_cuts", F.array_insert(inside, 1, F.lit(False)).alias("_in"))

    def _cells(self, todo: DataFrame, n_ranks: int, collect: bool, sketched: bool) -> DataFrame:
        """One pass: (slot, _c, _cnt, _lo, _hi, _vals | _sketch), ``_c`` numbers the cells of a group in order."""
        self.passes.append("collect" if collect else "narrow")
        j = _same(self.data, broadcast_if_small(self._brackets(todo, sketched), bound=n_ranks), self.keys)
        before = F.size(F.filter("_cuts", lambda c: c <= F.col("_i")))
        j = j.withColumn("_j", before).withColumn("_on", F.coalesce(F.get("_cuts", F.col("_j") - 1) == F.col("_i"), F.lit(False)))
        inner = F.when(~F.col("_on") & F.get("_in", F.col("_j")), F.col("_i"))
        j = j.select(*self.keys, "_p", "_i", (2 * F.col("_j") - F.col("_on").cast("int")).alias("_c"), inner.alias("_inner"))
        rows = [F.count(F.lit(1)).alias("_cnt"), F.min("_i").alias("_lo"), F.max("_i").alias("_hi")]
        keep = F.collect_list("_inner").alias("_vals") if collect else F.kll_sketch_agg_bigint("_inner", F.lit(self.k)).alias("_sketch")
        cells = self._by_slot(j.groupBy(*self.keys, "_p", "_c").agg(*rows, keep))
        if self.parts:
            keep = F.flatten(F.collect_list("_vals")).alias("_vals") if collect else F.kll_merge_agg_bigint("_sketch", F.lit(self.k)).alias("_sketch")
            cells = cells.groupBy(*self.slot, "_c").agg(F.sum("_cnt").alias("_cnt"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), keep)
        missing = F.lit(None).cast("binary").alias("_sketch") if collect else F.lit(None).cast("array<bigint>").alias("_vals")
        return cells.select("*", missing)

    def ranks(self, wanted: DataFrame, n_ranks: int) -> DataFrame:
        """(slot, _rank, _v) of ``wanted`` (slot, _rank, _n, _lo, _hi, _sketch)."""
        state = wanted.select(*self.slot, "_rank", "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_cnt"), "_sketch",
                              F.lit(None).cast("long").alias("_i"))
        done, out = [*self.slot, "_rank", "_i"], None
        # what a rank may collect at once; a cell that no bracket covers has no sketch
        weight = F.max(F.when(F.col("_cnt") <= self.k, 0.0).when(F.col("_sketch").isNull(), F.col("_cnt").cast("double"))
                       .otherwise(F.col("_cnt") * F.lit(10 * rank_error(self.k))))
        while True:
            state = state.withColumn("_i", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_i")))
            state, _ = _hold(state, self.held, F.count(F.lit(1)), checkpoint=out is not None)
            settled = state.where(F.col("_i").isNotNull()).select(*done)
            out = settled if out is None else out.unionByName(settled)
            todo = state.where(F.col("_i").isNull())
            most, = todo.agg(weight).first()
            if most is None:
                return out.select(*self.slot, "_rank", value_of(F.col("_i")).alias("_v"))
            cells = self._cells(todo, n_ranks, most <= self.leaf_rows, most > 0)
            w = Window.partitionBy(*self.slot).orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
            cells = cells.withColumn("_to", F.sum("_cnt").over(w)).withColumn("_below", F.col("_to") - F.col("_cnt"))
            found = _same(cells, todo.select(*self.slot, "_rank"), self.slot).where((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_to")))
            value = F.when(F.size("_vals") == F.col("_cnt"), F.get(F.array_sort("_vals"), (F.col("_rank") - F.col("_below")).cast("int")))
            sketch = F.when(F.kll_sketch_get_n_bigint("_sketch") == F.col("_cnt"), F.col("_sketch"))
            state = found.select(*self.slot, "_rank", "_lo", "_hi", "_below", "_cnt", sketch.alias("_sketch"), value.alias("_i"))


def _selected(data: DataFrame, keys: Sequence[str], parts: bool, probs: Sequence[float], k: int, leaf_rows: int, keep_input: bool,
              passes: list | None) -> DataFrame:
    """(keys, _all, _s, p_idx, p, q) for all slots."""
    data = data.withColumn("_i", image(F.col("_x"))).drop("_x")
    if keep_input:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    run = _Selection(data, keys, parts, k, leaf_rows, passes)
    stats, (n_groups,) = _hold(run.groups(), run.held, F.count(F.lit(1)))
    targets = _targets(stats, run.slot, probs)
    wanted = (targets.select(*run.slot, F.explode(F.array("_r0", "_r1")).alias("_rank")).distinct())
    wanted = _same(wanted, stats, run.slot)
    values = run.ranks(wanted, n_groups)
    at = lambda r, v: values.select(*run.slot, F.col("_rank").alias(r), F.col("_v").alias(v))
    out = _same(_same(targets, at("_r0", "_v0"), [*run.slot, "_r0"]), at("_r1", "_v1"), [*run.slot, "_r1"])
    result = hold(out.select(*run.slot, "p_idx", "p", _interpolated().alias("q")))
    result.count()
    if keep_input:
        data.unpersist()
    for h in run.held:
        h.unpersist()
    return result


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    k: int = SKETCH_K,
    leaf_rows: int = 250_000,
    keep_input: bool = True,
    passes: list | None = None,
) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys`` group, long format.

    Returns ``keys + [p_idx, p, q]``; NULL/NaN values are ignored (pandas and SQL
    semantics).  ``keys`` may be empty for a global quantile.  ``keep_input`` caches the
    values between the passes; callers that derive them from a cached table turn it off.
    ``k`` (256 at least) is the size of the sketches, ``leaf_rows`` what one cell may collect;
    ``passes`` is filled with the passes over the values.
    """
    if len(probs) > SORT_THRESHOLD:
        return sorted_quantiles(df, keys, value, probs)
    user_keys = list(keys)
    data, keys = _prepare(df, user_keys, value)
    out = _selected(data.withColumn("_p", F.lit(0)), keys, False, probs, k, leaf_rows, keep_input, passes)
    return out.select(*user_keys, "p_idx", "p", "q")


def complement_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    part: str,
    value: str,
    probs: Sequence[float],
    *,
    k: int = SKETCH_K,
    leaf_rows: int = 250_000,
    keep_input: bool = True,
    passes: list | None = None,
) -> DataFrame:
    """Exact quantiles of each group's rows OUTSIDE each of its parts (out-of-fold), and of all its rows.

    Returns ``keys + [part, whole, p_idx, p, q]``: one row per part of the group that leaves any rows, and
    one with ``whole`` true and a NULL part.  The passes are those of :func:`group_quantiles`; no row is copied.
    """
    user_keys = list(keys)
    x = F.col(value).cast("double")
    data = df.select(*[F.col(c) for c in user_keys], F.col(part).alias("_p"), x.alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    if not user_keys:
        data = data.withColumn(_G, F.lit(0))
    out = _selected(data, user_keys or [_G], True, probs, k, leaf_rows, keep_input, passes)
    return out.select(*user_keys, F.col("_s").alias(part), F.col("_all").alias("whole"), "p_idx", "p", "q")


def group_quantiles_wide(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str], **kw
) -> DataFrame:
    """Like :func:`group_quantiles` but one column per probability (``names``)."""
    long = group_quantiles(df, keys, value, probs, **kw)
    aggs = [F.max(F.when(F.col("p_idx") == i, F.col("q"))).alias(n) for i, n in enumerate(names)]
    if keys:
        return long.groupBy(*keys).agg(*aggs)
    return long.agg(*aggs)


def multi_column_quantiles(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], probs: Sequence[float], **kw
) -> DataFrame:
    """Quantiles of several columns in the same passes: stack to long, key by column name.

    Returns ``keys + [column, p_idx, p, q]``.
    """
    stack = F.explode(
        F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("_val")) for v in values])
    )
    long = df.select(*keys, stack.alias("_s")).select(*keys, "_s.column", "_s._val")
    return group_quantiles(long, [*keys, "column"], "_val", probs, **kw)


def global_quantiles(df: DataFrame, value: str, probs: Sequence[float], **kw) -> list[float | None]:
    """Driver-side list of a handful of global quantiles (bounded: one value per prob)."""
    rows = group_quantiles(df, [], value, probs, **kw).collect()
    by_idx = {r["p_idx"]: r["q"] for r in rows}
    return [by_idx.get(i) for i in range(len(probs))]


def placeholder(dtype: str):
    """A constant of the given simple type, used as the group value of the global set."""
    return F.lit("") if dtype == "string" else F.lit(0).cast(dtype)


def quantiles_with_global(df: DataFrame, group: str, values: Sequence[str], probs: Sequence[float], **kw):
    """Per-group AND global quantiles of several columns in one run.

    Rows are stacked once per value column and once per grouping set (the group,
    and everything), so all statistics share the same passes over the data.
    Returns ``(group_table, global_table)`` in long form ``[group,] column, p_idx, q``.
    """
    dtype = dict(df.dtypes)[group]
    sets = F.explode(F.array(
        F.struct(F.lit(0).alias("_set"), F.col(f"`{group}`").alias("_g")),
        F.struct(F.lit(1).alias("_set"), placeholder(dtype).alias("_g")),
    ))
    stack = F.explode(F.array(*[F.struct(F.lit(v).alias("column"), F.col(f"`{v}`").cast("double").alias("_val"))
                                for v in values]))
    source = df.select(*[F.col(f"`{c}`") for c in sorted({group, *values})]).persist(StorageLevel.MEMORY_AND_DISK)
    long = source.select(sets.alias("_s"), stack.alias("_v")).select("_s._set", "_s._g", "_v.column", "_v._val")
    q = group_quantiles(long, ["_set", "_g", "column"], "_val", probs, keep_input=False, **kw)
    source.unpersist()
    per_group = q.where("_set = 0").select(F.col("_g").alias(group), "column", "p_idx", "q")
    overall = q.where("_set = 1").select("column", "p_idx", "q")
    return per_group, overall


def sorted_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles for MANY probabilities: one range-partitioned sort on ``(keys, value)``
    gives every row its global position; a group's k-th value is the row at
    ``group_start + k``.  Only the needed rows are kept (an equi-join on the position
    against the small table of target positions).  Same output as :func:`group_quantiles`.
    """
    from plinth.functions.ordered import global_row_number

    user_keys = list(keys)
    data, keys = _prepare(df, user_keys, value)
    order = [F.col(k) for k in keys] + [F.col("_x")]
    ranked = global_row_number(data, order, "_pos")  # 1-based, groups contiguous
    starts = ranked.groupBy(*keys).agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    held: list[DataFrame] = []
    targets, (n_targets,) = _hold(_targets(starts, keys, probs, "_start"), held, F.count(F.lit(1)))
    targets = targets.withColumn("_p0", F.col("_start") + F.col("_r0")).withColumn("_p1", F.col("_start") + F.col("_r1"))
    need = targets.select(F.explode(F.array("_p0", "_p1")).alias("_pos")).distinct()
    vals, _ = _hold(ranked.join(broadcast_if_small(need, bound=2 * (n_targets or 0)), "_pos").select("_pos", F.col("_x").alias("_v")),
                    held, F.count(F.lit(1)))
    v0 = vals.select(F.col("_pos").alias("_p0"), F.col("_v").alias("_v0"))
    v1 = vals.select(F.col("_pos").alias("_p1"), F.col("_v").alias("_v1"))
    out = targets.join(v0, "_p0").join(v1, "_p1")
    result = out.select(*user_keys, "p_idx", "p", _interpolated().alias("q"))
    result = hold(result)
    result.count()
    for h in held:
        h.unpersist()
    return result


def quantiles_by_groupings(df: DataFrame, groupings: dict[str, Sequence[str]], probs: Sequence[float], **kw):
    """Per-group and global quantiles for several (group column -> value columns) at once.

    Every row is stacked once per (grouping, value column) with the group value as
    text, plus once more into that grouping's global set, so ALL statistics share
    one run.  Returns ``(per_group, overall)``: ``grouping, gval, column,
    p_idx, q`` and ``grouping, column, p_idx, q``.
    """
    items = []
    for g, values in groupings.items():
        for v in values:
            for glob in (0, 1):
                gval = F.lit("") if glob else F.col(f"`{g}`").cast("string")
                items.append(F.struct(F.lit(g).alias("grouping"), F.lit(glob).alias("_set"), gval.alias("gval"),
                                      F.lit(v).alias("column"), F.col(f"`{v}`").cast("double").alias("_val")))
    used = sorted({*groupings, *(v for values in groupings.values() for v in values)})
    source = df.select(*[F.col(f"`{c}`") for c in used]).persist(StorageLevel.MEMORY_AND_DISK)
    # rows are spread over the sets in every pass, right below the map-side combine; only the source is cached
    long = source.select(F.explode(F.array(*items)).alias("_s")).select("_s.*")
    q = group_quantiles(long, ["grouping", "_set", "gval", "column"], "_val", probs, keep_input=False, **kw)
    source.unpersist()
    per_group = q.where("_set = 0").select("grouping", "gval", "column", "p_idx", "q")
    overall = q.where("_set = 1").select("grouping", "column", "p_idx", "q")
    return per_group, overall
