"""Data-quality and leakage checks: M01-M14.

Every check returns rows ``(check, column, passed, detail)`` computed by one or
two aggregates over the data; the raising wrappers are thin.  ``detail`` holds
counts as text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.sizing import broadcast_if_small, hold
from plinth.operators.clean import is_numeric
from plinth.operators.features import col

SCHEMA = "check string, column string, passed boolean, detail string"


class DataLeakageError(Exception):
    pass


class DataIntegrityError(Exception):
    pass


def _row(check: str, column: str | None, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                    passed.cast("boolean").alias("passed"), detail.cast("string").alias("detail"))


def _table(agg_row: DataFrame, rows: list[Column]) -> DataFrame:
    return agg_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def raw_integrity(df: DataFrame, key: Sequence[str], target: str | None) -> DataFrame:
    """Rows > 0, no duplicate rows, key unique, target present / non-null / positive.

    Equal rows have equal keys, so only rows of keys that occur more than once are compared whole."""
    key = list(key)
    has_t = target is not None and target in df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    if has_t:
        aggs += [F.sum(F.when(col(target).isNull(), 1).otherwise(0)).alias("_tn"),
                 F.sum(F.when(col(target) <= 0, 1).otherwise(0)).alias("_tp")]
    per_key = df.groupBy(*[col(c) for c in key]).agg(*aggs)
    repeated = per_key.where("_n > 1").select(*[col(c).alias(f"_k_{i}") for i, c in enumerate(key)])
    same = reduce(and_, [col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(key)])
    whole = df.join(broadcast_if_small(repeated), same, "left_semi").groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    extra = whole.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("dup"))
    a = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("nk"),
                    *([F.sum("_tn").alias("tn"), F.sum("_tp").alias("tp")] if has_t else [])).crossJoin(extra)  # one row each
    n, nk = F.col("n"), F.col("nk")
    rows = [_row("rows_nonzero", None, n > 0, n),
            _row("no_duplicate_rows", None, F.col("dup") == 0, F.col("dup")),
            _row("key_unique", ",".join(key), n == nk, n - nk),
            _row("target_present", target, F.lit(has_t), F.lit(None))]
    if has_t:
        rows += [_row("target_not_null", target, F.col("tn") == 0, F.col("tn")),
                 _row("target_positive", target, F.col("tp") == 0, F.col("tp"))]
    return _table(a, rows)


def train_test_overlap(train: DataFrame, test: DataFrame, key: str, target: str | None = None) -> DataFrame:
    """Keys shared by train and test (left-semi join count) and column parity."""
    overlap = train.select(key).join(test.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("n"))
    tcols = set(train.columns) - ({target} if target else set())
    missing = sorted(tcols - set(test.columns))
    extra = sorted(set(test.columns) - set(train.columns))
    rows = [_row("key_overlap", key, F.col("n") == 0, F.col("n")),
            _row("columns_missing_in_test", None, F.lit(not missing), F.lit(",".join(missing))),
            _row("columns_extra_in_test", None, F.lit(not extra), F.lit(",".join(extra)))]
    return _table(overlap, rows)


def range_shift(train: DataFrame, test: DataFrame, cols: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Warn when a test column's range exceeds ``factor`` x the train range."""
    tagged = train.select(*[col(c) for c in cols], F.lit(True).alias("_a")).unionByName(
        test.select(*[col(c) for c in cols], F.lit(False).alias("_a")))
    aggs = []
    for tag, side in (("a", F.col("_a")), ("b", ~F.col("_a"))):
        aggs += [F.min(F.when(side, col(c))).alias(f"{tag}lo{i}") for i, c in enumerate(cols)]
        aggs += [F.max(F.when(side, col(c))).alias(f"{tag}hi{i}") for i, c in enumerate(cols)]
    both = tagged.agg(*aggs)  # one pass over both sides
    rows = []
    for i, c in enumerate(cols):
        ra = F.col(f"ahi{i}") - F.col(f"alo{i}")
        rb = F.col(f"bhi{i}") - F.col(f"blo{i}")
        rows.append(_row("range_shift", c, F.coalesce(rb <= ra * factor, F.lit(True)), F.round(rb, 6)))
    return _table(both, rows)


def target_transform_check(df: DataFrame, raw: str, logged: str, rtol: float = 1e-6) -> DataFrame:
    """``logged == log1p(raw)`` within relative tolerance."""
    bad = F.abs(col(logged) - F.log1p(col(raw))) > F.lit(rtol) * F.abs(F.log1p(col(raw))) + F.lit(1e-12)
    a = df.agg(F.sum(F.when(bad, 1).otherwise(0)).alias("bad"))
    return _table(a, [_row("target_transform", logged, F.col("bad") == 0, F.col("bad"))])


def correlation(x: Column, y: Column) -> Column:
    """Pearson's correlation of the rows that have both; NULL where one of them is constant (``corr`` raises there
    in ANSI mode)."""
    a, b = F.when(y.isNotNull(), x.cast("double")), F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def long_form(df: DataFrame, cols: Sequence[str], *keep: Column) -> DataFrame:
    """(i, x) and ``keep``: a row per value, ``i`` the column's position.  Only ever aggregated by ``i``, so it is
    combined before the shuffle to one row a column and task, and the generated code has one size for any number of columns."""
    return df.select(*keep, F.inline(F.array(*[F.struct(F.lit(i).alias("i"), col(c).cast("double").alias("x")) for i, c in enumerate(cols)])))


def correlations(df: DataFrame, target: str, features: Sequence[str]) -> list[float | None]:
    """:func:`correlation` of every feature with the target, in one pass; the driver receives a number a feature."""
    if not features:
        return []
    x, y = F.when(F.col("_y").isNotNull(), F.col("x")), F.when(F.col("x").isNotNull(), F.col("_y").cast("double"))
    # partial means of equal values may differ by a rounding error, whose correlation is noise
    varies = [(F.min(v) < F.max(v)) | F.isnan(F.max(v)) for v in (x, y)]
    pairs = long_form(df, features, col(target).alias("_y")).groupBy("i").agg(
        F.when(varies[0] & varies[1], correlation(F.col("x"), F.col("_y"))).alias("c"))
    found = {r["i"]: r["c"] for r in pairs.collect()}
    return [found.get(i) for i in range(len(features))]


def leakage_correlation(train: DataFrame, target: str, features: Sequence[str], test: DataFrame | None = None,
                        threshold: float = 0.99, max_features: int | None = None) -> DataFrame:
    """|corr(feature, target)| above ``threshold`` is suspicious; a feature missing in
    test is an error.  ``max_features`` caps how many are checked (the reference checks 20)."""
    feats = list(features)[:max_features] if max_features else list(features)
    known = correlations(train, target, feats)
    # an undefined correlation (a constant or infinite feature) is no sign of a leak
    rows = [_row("leakage_corr", f, F.coalesce(F.abs(F.nanvl(c, F.lit(0.0))) <= threshold, F.lit(True)), F.round(c, 6))
            for f, c in ((f, F.lit(v).cast("double")) for f, v in zip(feats, known))]
    if test is not None:
        rows += [_row("feature_in_test", f, F.lit(f in test.columns), F.lit(None)) for f in feats]
    return _table(train.sparkSession.range(1), rows)


def null_counts(df: DataFrame, cols: Iterable[str] | None = None, check: str = "nulls") -> DataFrame:
    """NULL (and NaN) count per column in one aggregate."""
    cols = list(cols) if cols is not None else df.columns
    types = dict(df.dtypes)

    def isnull(c):
        e = col(c).isNull()
        return e | F.isnan(col(c)) if types[c] in ("double", "float") else e

    a = df.agg(*[F.sum(F.when(isnull(c), 1).otherwise(0)).alias(f"n{i}") for i, c in enumerate(cols)])
    return _table(a, [_row(check, c, F.coalesce(F.col(f"n{i}"), F.lit(0)) == 0, F.coalesce(F.col(f"n{i}"), F.lit(0)))
                      for i, c in enumerate(cols)])


def row_count_consistency(before: DataFrame, after: DataFrame, change_expected: bool = False) -> DataFrame:
    """Same row count before/after a stage (any change accepted when expected)."""
    tagged = before.select(F.lit(1).alias("_b")).unionByName(after.select(F.lit(0).alias("_b")))
    a = tagged.agg(F.sum("_b").alias("b"), F.sum(1 - F.col("_b")).alias("a"))
    ok = (F.col("a") == F.col("b")) | F.lit(change_expected)
    return _table(a, [_row("row_count", None, ok, F.concat_ws("->", F.col("b").cast("string"), F.col("a").cast("string")))])


def feature_sanity(df: DataFrame, cols: Sequence[str], area_cols: Sequence[str] = (), age_cols: Sequence[str] = (),
                   sigmas: float = 5.0, max_share: float = 0.01) -> DataFrame:
    """Non-finite values, share beyond ``sigmas`` std over ``max_share``, negative areas,
    ages outside [0, 200].  Pass 1: mean/std; pass 2: conditional counts."""
    st = {r["i"]: r for r in long_form(df, cols).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).collect()} if cols else {}
    n = st[0]["n"] if st else 0
    spread = [(st[i]["m"], st[i]["s"]) if i in st and st[i]["m"] is not None and st[i]["s"] else (None, None) for i in range(len(cols))]

    def own(values: list[float | None]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("double") for v in values]), F.col("i") + 1)

    found = {}
    if st:
        x = F.col("x")
        far = F.abs(x - own([m for m, _ in spread])) > sigmas * own([s for _, s in spread])
        found = {r["i"]: r for r in long_form(df, cols).groupBy("i").agg(
            F.sum(F.when(F.isnan(x) | (F.abs(x) == float("inf")), 1).otherwise(0)).alias("nf"),
            F.sum(F.when(far, 1).otherwise(0)).alias("o")).collect()}
    rows = []
    for i, c in enumerate(cols):
        nf, o = F.lit(found[i]["nf"] if i in found else None).cast("long"), F.lit(found[i]["o"] if i in found else 0).cast("long")
        rows.append(_row("finite", c, nf == 0, nf))
        rows.append(_row("outliers_5sigma", c, o <= F.lit(max_share * n), o))
    aggs = [F.sum(F.when(col(c) < 0, 1).otherwise(0)).alias(f"neg{j}") for j, c in enumerate(area_cols)]
    aggs += [F.sum(F.when((col(c) < 0) | (col(c) > 200), 1).otherwise(0)).alias(f"age{j}") for j, c in enumerate(age_cols)]
    rows += [_row("non_negative_area", c, F.col(f"neg{j}") == 0, F.col(f"neg{j}")) for j, c in enumerate(area_cols)]
    rows += [_row("age_in_range", c, F.col(f"age{j}") == 0, F.col(f"age{j}")) for j, c in enumerate(age_cols)]
    return _table(df.agg(*aggs) if aggs else df.sparkSession.range(1), rows)


def fold_validity(df: DataFrame, key: str, fold: str, k: int) -> DataFrame:
    """Every row validated, exactly once, all ``k`` folds non-empty, no unknown fold."""
    bad = (col(fold) < 0) | (col(fold) >= k) | col(fold).isNull()
    per_key = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("c"), F.count(col(fold)).alias("f"),
                                       F.min(col(fold)).alias("fmin"),
                                       F.sum(F.when(bad, 1).otherwise(0)).alias("b"))
    a = per_key.agg(F.sum(F.when(F.col("c") != 1, 1).otherwise(0)).alias("multi"),
                    F.sum(F.when(F.col("f") == 0, 1).otherwise(0)).alias("unvalidated"),
                    F.count_distinct(F.when(F.col("fmin").between(0, k - 1), F.col("fmin"))).alias("nf"),
                    F.sum("b").alias("bad"))
    rows = [_row("every_row_validated", key, F.col("unvalidated") == 0, F.col("unvalidated")),
            _row("validated_exactly_once", key, F.col("multi") == 0, F.col("multi")),
            _row("all_folds_nonempty", fold, F.col("nf") == k, F.col("nf")),
            _row("fold_in_range", fold, F.col("bad") == 0, F.col("bad"))]
    return _table(a, rows)


def prediction_sanity(df: DataFrame, pred: str, log_space: bool = True, min_std: float = 1e-6) -> DataFrame:
    """Finite predictions, range warnings (log [0, 20] / real [0, 1e7]), non-constant."""
    x = col(pred).cast("double")
    lo, hi = (0.0, 20.0) if log_space else (0.0, 1e7)
    a = df.agg(F.sum(F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 1).otherwise(0)).alias("nf"),
               F.sum(F.when((x < lo) | (x > hi), 1).otherwise(0)).alias("oor"),
               F.stddev_pop(x).alias("sd"))
    rows = [_row("predictions_finite", pred, F.col("nf") == 0, F.col("nf")),
            _row("predictions_in_range", pred, F.col("oor") == 0, F.col("oor")),
            _row("predictions_not_constant", pred, F.coalesce(F.col("sd") >= min_std, F.lit(False)), F.round("sd", 6))]
    return _table(a, rows)


def submission_format(sub: DataFrame, ids: DataFrame, key: str, value: str,
                      order: str | None = None) -> DataFrame:
    """Required columns (without them that is the only row), size, no NULL, all positive, id
    set equal (full outer join);
    the order check runs only when an ordinal column ``order`` exists on both sides."""
    absent = [c for c in (key, value) if c not in sub.columns]
    if absent:
        one = sub.agg(F.count(F.lit(1)).alias("n"))
        return _table(one, [_row("columns", None, F.lit(False), F.lit(",".join(absent)))])
    j = sub.select(col(key), col(value), *( [col(order).alias("_os")] if order else [])) \
        .join(ids.select(col(key), F.lit(1).alias("_in"), *([col(order).alias("_oi")] if order else [])), key, "full")
    aggs = [F.sum(F.when(F.col("_in").isNull(), 1).otherwise(0)).alias("extra"),
            F.sum(F.when(col(value).isNull() & F.col("_in").isNotNull(), 1).otherwise(0)).alias("missing"),
            F.sum(F.when(col(value) <= 0, 1).otherwise(0)).alias("nonpos"),
            F.count(col(value)).alias("n"), F.count(F.col("_in")).alias("m")]
    if order:
        aggs.append(F.sum(F.when(F.col("_os") != F.col("_oi"), 1).otherwise(0)).alias("misordered"))
    a = j.agg(*aggs)
    rows = [_row("columns", None, F.lit(True), F.lit(",".join(sub.columns))),
            _row("size", None, F.col("n") == F.col("m"), F.col("n")),
            _row("no_nulls", value, F.col("missing") == 0, F.col("missing")),
            _row("positive", value, F.col("nonpos") == 0, F.col("nonpos")),
            _row("id_set_match", key, (F.col("extra") == 0) & (F.col("missing") == 0), F.col("extra"))]
    if order:
        rows.append(_row("id_order_match", key, F.col("misordered") == 0, F.col("misordered")))
    return _table(a, rows)


def model_input_gate(train: DataFrame, test: DataFrame, key: str, target: str, features: Sequence[str]) -> DataFrame:
    """Nulls in features, leakage correlation, train/test parity and key overlap."""
    return (null_counts(train, features).unionByName(null_counts(test, [f for f in features if f in test.columns]))
            .unionByName(leakage_correlation(train, target, features, test))
            .unionByName(train_test_overlap(train, test, key, target)))


def frame_validation(df: DataFrame, required: Sequence[str], allowed_extra: bool = True) -> DataFrame:
    """Empty frame, missing / extra columns, all-NULL columns (one aggregate)."""
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in required]
    a = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(f"v{i}") for i, c in enumerate(df.columns)])
    rows = [_row("not_empty", None, F.col("n") > 0, F.col("n")),
            _row("missing_columns", None, F.lit(not missing), F.lit(",".join(missing))),
            _row("extra_columns", None, F.lit(allowed_extra or not extra), F.lit(",".join(extra)))]
    rows += [_row("not_all_null", c, (F.col(f"v{i}") > 0) | (F.col("n") == 0), F.col(f"v{i}"))
             for i, c in enumerate(df.columns)]
    return _table(a, rows)


def stage_gate(results: Sequence[DataFrame], stage: str) -> DataFrame:
    """Union of check tables plus one summary row (``bool_and`` of all checks)."""
    u = results[0]
    for r in results[1:]:
        u = u.unionByName(r)
    u = hold(u)  # a few rows; read for the result and for its summary
    summary = u.agg(F.bool_and("passed").alias("ok"), F.sum(F.when(~F.col("passed"), 1).otherwise(0)).alias("bad"))
    return u.unionByName(_table(summary, [_row("stage_gate", stage, F.col("ok"), F.col("bad"))]))


def raise_on_failure(results: DataFrame, leakage_checks: Iterable[str] = ("key_overlap", "leakage_corr")) -> None:
    """Raise like the reference (leakage vs integrity) when any check failed."""
    failed = results.where(~F.col("passed")).collect()  # one row per check and column
    leak = [r for r in failed if r["check"] in set(leakage_checks)]
    if leak:
        raise DataLeakageError("; ".join(f"{r['check']}({r['column']}): {r['detail']}" for r in leak))
    if failed:
        raise DataIntegrityError("; ".join(f"{r['check']}({r['column']}): {r['detail']}" for r in failed))


