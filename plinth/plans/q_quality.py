"""Queries for the data-quality and leakage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators import folds as fo
from plinth.operators import quality as qa
from plinth.plans.catalog import register
from plinth.plans.common import ERRORS_CTE, filled, nation_mean_predictions
from plinth.plans.facts import FACTS_CTE, FILLED_CTE, order_facts, table


def rows_sql(src: str, rows: list[tuple[str, str | None, str, str | None]], extra: str = "") -> str:
    """SQL for check rows ``(check, column, passed_expr, detail_expr)`` over a one-row source."""
    parts = []
    for check, column, passed, detail in rows:
        c = f"'{column}'" if column is not None else "CAST(NULL AS VARCHAR)"
        dt = f"CAST({detail} AS VARCHAR)" if detail is not None else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT {extra}'{check}' AS \"check\", {c} AS \"column\", CAST({passed} AS BOOLEAN) AS passed, "
                     f"{dt} AS detail FROM {src}")
    return " UNION ALL ".join(parts)


def fmt6(expr: str) -> str:
    return f"printf('%.6f', round({expr}, 6))"


def tag(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.select(F.lit(value).alias(name), *df.columns)


# ---------------------------------------------------------------- M01
def _m01_sql(tbl: str, key: list[str], target: str) -> str:
    src = f"""(SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM {tbl})) AS nd,
       (SELECT count(*) FROM (SELECT DISTINCT {', '.join(key)} FROM {tbl})) AS nk,
       sum(CASE WHEN {target} IS NULL THEN 1 ELSE 0 END) AS tn, sum(CASE WHEN {target} <= 0 THEN 1 ELSE 0 END) AS tp
       FROM {tbl}) a"""
    return rows_sql(src, [("rows_nonzero", None, "n > 0", "n"), ("no_duplicate_rows", None, "n = nd", "n - nd"),
                          ("key_unique", ",".join(key), "n = nk", "n - nk"), ("target_present", target, "true", None),
                          ("target_not_null", target, "tn = 0", "tn"), ("target_positive", target, "tp = 0", "tp")],
                    extra=f"'{tbl}' AS tbl, ")


M01_SQL = _m01_sql("orders", ["o_orderkey"], "o_totalprice") + " UNION ALL " + \
    _m01_sql("lineitem", ["l_orderkey", "l_linenumber"], "l_extendedprice")


@register("m01_raw_integrity", M01_SQL)
def m01_raw_integrity(spark, d):
    a = tag(qa.raw_integrity(table(spark, d, "orders"), ["o_orderkey"], "o_totalprice"), "tbl", "orders")
    b = tag(qa.raw_integrity(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_extendedprice"),
            "tbl", "lineitem")
    return a.unionByName(b)


# ---------------------------------------------------------------- M02
M02_SQL = f"""WITH {FILLED_CTE},
o1 AS (SELECT count(*) AS n FROM filled a WHERE a.is_train AND a.okey IN (SELECT okey FROM filled WHERE NOT is_train)),
o2 AS (SELECT count(*) AS n FROM filled a WHERE a.is_train AND a.okey IN (SELECT okey FROM filled))
{rows_sql('o1', [('key_overlap', 'okey', 'n = 0', 'n'), ('columns_missing_in_test', None, 'true', "''"),
                 ('columns_extra_in_test', None, 'true', "''")], extra="'train_vs_test' AS pair, ")}
UNION ALL
{rows_sql('o2', [('key_overlap', 'okey', 'n = 0', 'n'), ('columns_missing_in_test', None, 'true', "''"),
                 ('columns_extra_in_test', None, 'true', "''")], extra="'train_vs_all' AS pair, ")}"""


@register("m02_train_test_overlap", M02_SQL)
def m02_train_test_overlap(spark, d):
    f = filled(spark, d)
    train, test = f.where("is_train"), f.where("NOT is_train").drop("y")
    a = tag(qa.train_test_overlap(train, test, "okey", "y"), "pair", "train_vs_test")
    b = tag(qa.train_test_overlap(train, f, "okey", "y"), "pair", "train_vs_all")
    return a.unionByName(b)


# ---------------------------------------------------------------- M03
M03_COLS = ["sum_qty", "sum_price", "acctbal", "avg_disc"]
M03_SQL = f"""WITH {FILLED_CTE},
a AS (SELECT {', '.join(f"max({c}) FILTER (WHERE is_train) - min({c}) FILTER (WHERE is_train) AS ra{i}, "
                         f"max({c}) FILTER (WHERE NOT is_train) - min({c}) FILTER (WHERE NOT is_train) AS rb{i}"
                         for i, c in enumerate(M03_COLS))} FROM filled)
{rows_sql('a', [('range_shift', c, f'coalesce(rb{i} <= ra{i} * 1.5, true)', fmt6(f'rb{i}')) for i, c in enumerate(M03_COLS)])}"""


@register("m03_range_shift", M03_SQL)
def m03_range_shift(spark, d):
    f = filled(spark, d)
    out = qa.range_shift(f.where("is_train"), f.where("NOT is_train"), M03_COLS)
    return out.withColumn("detail", F.format_string("%.6f", F.round(F.col("detail").cast("double"), 6)))


# ---------------------------------------------------------------- M04
M04_SQL = """WITH v AS (SELECT o_totalprice AS p, ln(1 + o_totalprice) AS good, ln(o_totalprice) AS bad FROM orders),
a AS (SELECT sum(CASE WHEN abs(good - ln(1 + p)) > 1e-6 * abs(ln(1 + p)) + 1e-12 THEN 1 ELSE 0 END) AS g,
             sum(CASE WHEN abs(bad - ln(1 + p)) > 1e-6 * abs(ln(1 + p)) + 1e-12 THEN 1 ELSE 0 END) AS b FROM v)
""" + rows_sql("a", [("target_transform", "good", "g = 0", "g"), ("target_transform", "bad", "b = 0", "b")])


@register("m04_target_transform", M04_SQL)
def m04_target_transform(spark, d):
    o = table(spark, d, "orders").select(F.col("o_totalprice").alias("p"), F.log1p("o_totalprice").alias("good"),
                                         F.log("o_totalprice").alias("bad"))
    return qa.target_transform_check(o, "p", "good").unionByName(qa.target_transform_check(o, "p", "bad"))


# ---------------------------------------------------------------- M05
M05_FEATS = ["sum_price", "n_lines", "sum_qty", "acctbal", "avg_disc"]
M05_SQL = f"""WITH {FILLED_CTE},
a AS (SELECT {', '.join(f'corr({c}, y) AS c{i}' for i, c in enumerate(M05_FEATS))} FROM filled WHERE is_train)
{rows_sql('a', [('leakage_corr', c, f'coalesce(abs(c{i}) <= 0.99, true)', fmt6(f'c{i}')) for i, c in enumerate(M05_FEATS)]
          + [('feature_in_test', c, 'true', None) for c in M05_FEATS])}"""


@register("m05_leakage_correlation", M05_SQL)
def m05_leakage_correlation(spark, d):
    f = filled(spark, d)
    out = qa.leakage_correlation(f.where("is_train"), "y", M05_FEATS, f.where("NOT is_train"))
    detail = F.when(F.col("detail").isNotNull(), F.format_string("%.6f", F.round(F.col("detail").cast("double"), 6)))
    return out.withColumn("detail", detail)


# ---------------------------------------------------------------- M06
M06_COLS = [("okey", False), ("status", False), ("y", True), ("n_lines", False), ("sum_qty", True),
            ("sum_price", True), ("avg_disc", True), ("first_ship", False), ("segment", False), ("nation", False),
            ("acctbal", True), ("order_year", False)]
M06_SQL = f"""WITH {FACTS_CTE},
a AS (SELECT {', '.join(f"sum(CASE WHEN {c} IS NULL {'OR isnan(' + c + ')' if dbl else ''} THEN 1 ELSE 0 END) AS n{i}"
                         for i, (c, dbl) in enumerate(M06_COLS))} FROM facts)
{rows_sql('a', [('nulls', c, f'n{i} = 0', f'n{i}') for i, (c, _) in enumerate(M06_COLS)])}"""


@register("m06_null_counts", M06_SQL)
def m06_null_counts(spark, d):
    return qa.null_counts(order_facts(spark, d), [c for c, _ in M06_COLS])


# ---------------------------------------------------------------- M07
M07_SQL = f"""WITH {FACTS_CTE},
a AS (SELECT (SELECT count(*) FROM facts) AS b,
             (SELECT count(*) FROM facts WHERE NOT (is_train AND coalesce(sum_qty > 250 AND y < 10, false))) AS a1)
SELECT 'outliers' AS stage, 'row_count' AS "check", CAST(NULL AS VARCHAR) AS "column", true AS passed,
       CAST(b AS VARCHAR) || '->' || CAST(a1 AS VARCHAR) AS detail FROM a
UNION ALL
SELECT 'outliers_strict', 'row_count', CAST(NULL AS VARCHAR), a1 = b, CAST(b AS VARCHAR) || '->' || CAST(a1 AS VARCHAR) FROM a
UNION ALL
SELECT 'fill', 'row_count', CAST(NULL AS VARCHAR), true, CAST(b AS VARCHAR) || '->' || CAST(b AS VARCHAR) FROM a"""


@register("m07_row_count_consistency", M07_SQL)
def m07_row_count_consistency(spark, d):
    from plinth.operators.clean import remove_outliers
    f = order_facts(spark, d)
    after = remove_outliers(f, (F.col("sum_qty") > 250) & (F.col("y") < 10))
    return (tag(qa.row_count_consistency(f, after, True), "stage", "outliers")
            .unionByName(tag(qa.row_count_consistency(f, after, False), "stage", "outliers_strict"))
            .unionByName(tag(qa.row_count_consistency(f, filled(spark, d), False), "stage", "fill")))


# ---------------------------------------------------------------- M08
M08_COLS = ["sum_qty", "sum_price", "acctbal", "avg_disc", "n_lines"]
M08_SQL = f"""WITH {FILLED_CTE},
x AS (SELECT *, ship_year - order_year AS Age FROM filled),
st AS (SELECT count(*) AS n, {', '.join(f'avg({c}) AS m{i}, stddev_samp({c}) AS s{i}' for i, c in enumerate(M08_COLS))} FROM x),
a AS (SELECT n, {', '.join(f"sum(CASE WHEN isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) THEN 1 ELSE 0 END) AS nf{i}, "
                            f"sum(CASE WHEN abs({c} - m{i}) > 5 * s{i} THEN 1 ELSE 0 END) AS o{i}"
                            for i, c in enumerate(M08_COLS))},
             sum(CASE WHEN sum_qty < 0 THEN 1 ELSE 0 END) AS neg0, sum(CASE WHEN acctbal < 0 THEN 1 ELSE 0 END) AS neg1,
             sum(CASE WHEN Age < 0 OR Age > 200 THEN 1 ELSE 0 END) AS age0
      FROM x CROSS JOIN st GROUP BY n)
{rows_sql('a', [r for i, c in enumerate(M08_COLS) for r in (('finite', c, f'nf{i} = 0', f'nf{i}'),
                                                             ('outliers_5sigma', c, f'o{i} <= 0.01 * n', f'o{i}'))]
          + [('non_negative_area', 'sum_qty', 'neg0 = 0', 'neg0'), ('non_negative_area', 'acctbal', 'neg1 = 0', 'neg1'),
             ('age_in_range', 'Age', 'age0 = 0', 'age0')])}"""


@register("m08_feature_sanity", M08_SQL)
def m08_feature_sanity(spark, d):
    f = filled(spark, d).withColumn("Age", F.col("ship_year") - F.col("order_year"))
    return qa.feature_sanity(f, M08_COLS, ["sum_qty", "acctbal"], ["Age"])


# ---------------------------------------------------------------- M09
def _hash(seed):
    return f"(((okey % 2147483648) * 1103515245 + 12345 + {seed}) % 2147483648)"


M09_SQL = f"""WITH {FILLED_CTE},
v1 AS (SELECT okey, CAST({_hash(42)} % 5 AS INTEGER) AS fold FROM filled),
v2 AS (SELECT * FROM v1 UNION ALL SELECT okey, CAST({_hash(43)} % 5 AS INTEGER) FROM filled),
{', '.join(f'''pk{j} AS (SELECT okey, count(*) AS c, count(fold) AS f, min(fold) AS fmin,
      sum(CASE WHEN fold < 0 OR fold >= 5 OR fold IS NULL THEN 1 ELSE 0 END) AS b FROM v{j} GROUP BY okey),
a{j} AS (SELECT sum(CASE WHEN c <> 1 THEN 1 ELSE 0 END) AS multi, sum(CASE WHEN f = 0 THEN 1 ELSE 0 END) AS unv,
      count(DISTINCT CASE WHEN fmin BETWEEN 0 AND 4 THEN fmin END) AS nf, sum(b) AS bad FROM pk{j})''' for j in (1, 2))}
""" + " UNION ALL ".join(rows_sql(f"a{j}", [("every_row_validated", "okey", "unv = 0", "unv"),
                                           ("validated_exactly_once", "okey", "multi = 0", "multi"),
                                           ("all_folds_nonempty", "fold", "nf = 5", "nf"),
                                           ("fold_in_range", "fold", "bad = 0", "bad")], extra=f"'{name}' AS variant, ")
                         for j, name in ((1, "kfold"), (2, "two_assignments")))


@register("m09_fold_validity", M09_SQL)
def m09_fold_validity(spark, d):
    f = filled(spark, d).select("okey")
    v1 = fo.kfold(f, "okey", 5, 42)
    v2 = v1.unionByName(fo.kfold(f, "okey", 5, 43))
    return tag(qa.fold_validity(v1, "okey", "fold", 5), "variant", "kfold").unionByName(
        tag(qa.fold_validity(v2, "okey", "fold", 5), "variant", "two_assignments"))


# ---------------------------------------------------------------- M10
M10_SQL = f"""WITH {ERRORS_CTE},
p AS (SELECT pred AS lp, exp(pred) - 1 AS rp FROM errors),
a AS (SELECT sum(CASE WHEN lp IS NULL OR isnan(lp) OR isinf(lp) THEN 1 ELSE 0 END) AS nf1,
             sum(CASE WHEN lp < 0 OR lp > 20 THEN 1 ELSE 0 END) AS oor1, stddev_pop(lp) AS sd1,
             sum(CASE WHEN rp IS NULL OR isnan(rp) OR isinf(rp) THEN 1 ELSE 0 END) AS nf2,
             sum(CASE WHEN rp < 0 OR rp > 10000000 THEN 1 ELSE 0 END) AS oor2, stddev_pop(rp) AS sd2 FROM p)
{rows_sql('a', [('predictions_finite', 'pred', 'nf1 = 0', 'nf1'), ('predictions_in_range', 'pred', 'oor1 = 0', 'oor1'),
                ('predictions_not_constant', 'pred', 'coalesce(sd1 >= 1e-6, false)', fmt6('sd1')),
                ('predictions_finite', 'pred_real', 'nf2 = 0', 'nf2'),
                ('predictions_in_range', 'pred_real', 'oor2 = 0', 'oor2'),
                ('predictions_not_constant', 'pred_real', 'coalesce(sd2 >= 1e-6, false)', fmt6('sd2'))])}"""


@register("m10_prediction_sanity", M10_SQL)
def m10_prediction_sanity(spark, d):
    e = nation_mean_predictions(filled(spark, d)).select("pred", F.expm1("pred").alias("pred_real"))
    out = qa.prediction_sanity(e, "pred", True).unionByName(qa.prediction_sanity(e, "pred_real", False))
    is_sd = F.col("check") == "predictions_not_constant"
    return out.withColumn("detail", F.when(is_sd, F.format_string("%.6f", F.round(F.col("detail").cast("double"), 6)))
                          .otherwise(F.col("detail")))


# ---------------------------------------------------------------- M11
M11_SQL = f"""WITH {ERRORS_CTE},
sub AS (SELECT okey, exp(pred) - 1 AS price FROM errors WHERE NOT is_train),
{', '.join(f'''j{j} AS (SELECT s.okey AS sk, s.price, i.okey AS ik FROM sub s FULL OUTER JOIN ({ids}) i ON i.okey = s.okey),
a{j} AS (SELECT sum(CASE WHEN ik IS NULL THEN 1 ELSE 0 END) AS extra,
      sum(CASE WHEN price IS NULL AND ik IS NOT NULL THEN 1 ELSE 0 END) AS missing,
      sum(CASE WHEN price <= 0 THEN 1 ELSE 0 END) AS nonpos, count(price) AS n, count(ik) AS m FROM j{j})'''
             for j, ids in ((1, "SELECT okey FROM filled WHERE NOT is_train"), (2, "SELECT okey FROM filled")))}
""" + " UNION ALL ".join(rows_sql(f"a{j}", [("columns", None, "true", "'okey,price'"), ("size", None, "n = m", "n"),
                                           ("no_nulls", "price", "missing = 0", "missing"),
                                           ("positive", "price", "nonpos = 0", "nonpos"),
                                           ("id_set_match", "okey", "extra = 0 AND missing = 0", "extra")],
                                  extra=f"'{name}' AS variant, ") for j, name in ((1, "test_ids"), (2, "all_ids")))


@register("m11_submission_format", M11_SQL)
def m11_submission_format(spark, d):
    f = filled(spark, d)
    e = nation_mean_predictions(f)
    sub = e.where("NOT is_train").select("okey", F.expm1("pred").alias("price"))
    a = tag(qa.submission_format(sub, f.where("NOT is_train").select("okey"), "okey", "price"), "variant", "test_ids")
    b = tag(qa.submission_format(sub, f.select("okey"), "okey", "price"), "variant", "all_ids")
    return a.unionByName(b)


M11_ORDER_SQL = f"""WITH {FILLED_CTE},
t AS (SELECT okey, okey - min(okey) OVER () AS pos FROM filled WHERE NOT is_train),
a AS (SELECT count(*) AS n, sum(CASE WHEN okey % 2 = 0 THEN 1 ELSE 0 END) AS bad FROM t)
{rows_sql('a', [('columns', None, 'true', "'okey,price,pos'"), ('size', None, 'true', 'n'), ('no_nulls', 'price', 'true', "'0'"),
                ('positive', 'price', 'true', "'0'"), ('id_set_match', 'okey', 'true', "'0'"), ('id_order_match', 'okey', 'bad = 0', 'bad')])}
UNION ALL SELECT 'columns' AS "check", CAST(NULL AS VARCHAR) AS "column", false AS passed, 'price' AS detail"""


@register("m11_submission_order", M11_ORDER_SQL)
def m11_submission_order(spark, d):
    """The same gate with an ordinal column that disagrees on even keys, and without the value column."""
    f = filled(spark, d).where("NOT is_train")
    low = f.agg(F.min("okey")).first()[0]
    pos = F.col("okey") - F.lit(low)
    sub = f.select("okey", F.expm1("y").alias("price"), F.when(F.col("okey") % 2 == 0, pos + 1).otherwise(pos).alias("pos"))
    want = f.select("okey", pos.alias("pos"))
    return qa.submission_format(sub, want, "okey", "price", "pos").unionByName(
        qa.submission_format(sub.drop("price"), want, "okey", "price"))


# ---------------------------------------------------------------- M12
M12_FEATS = ["n_lines", "sum_qty", "acctbal"]
M12_SQL = f"""WITH {FILLED_CTE},
n1 AS (SELECT {', '.join(f'sum(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) AS n{i}' for i, c in enumerate(M12_FEATS))}
       FROM filled WHERE is_train),
n2 AS (SELECT {', '.join(f'sum(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) AS n{i}' for i, c in enumerate(M12_FEATS))}
       FROM filled WHERE NOT is_train),
c AS (SELECT {', '.join(f'corr({c}, y) AS c{i}' for i, c in enumerate(M12_FEATS))} FROM filled WHERE is_train),
o AS (SELECT count(*) AS n FROM filled a WHERE a.is_train AND a.okey IN (SELECT okey FROM filled WHERE NOT is_train))
{rows_sql('n1', [('nulls', c, f'n{i} = 0', f'n{i}') for i, c in enumerate(M12_FEATS)])}
UNION ALL {rows_sql('n2', [('nulls', c, f'n{i} = 0', f'n{i}') for i, c in enumerate(M12_FEATS)])}
UNION ALL {rows_sql('c', [('leakage_corr', c, f'coalesce(abs(c{i}) <= 0.99, true)', fmt6(f'c{i}')) for i, c in enumerate(M12_FEATS)]
                    + [('feature_in_test', c, 'true', None) for c in M12_FEATS])}
UNION ALL {rows_sql('o', [('key_overlap', 'okey', 'n = 0', 'n'), ('columns_missing_in_test', None, 'true', "''"),
                          ('columns_extra_in_test', None, 'true', "''")])}"""


@register("m12_model_input_gate", M12_SQL)
def m12_model_input_gate(spark, d):
    f = filled(spark, d).drop("first_ship")
    out = qa.model_input_gate(f.where("is_train"), f.where("NOT is_train").drop("y"), "okey", "y", M12_FEATS)
    is_corr = F.col("check") == "leakage_corr"
    return out.withColumn("detail", F.when(is_corr, F.format_string("%.6f", F.round(F.col("detail").cast("double"), 6)))
                          .otherwise(F.col("detail")))


# ---------------------------------------------------------------- M13
M13_REQ = ["okey", "y", "nation", "SalePrice"]
M13_ALL = ["okey", "custkey", "status", "priority", "y", "n_lines", "sum_qty", "sum_price", "avg_disc", "first_ship",
           "segment", "nation", "acctbal", "order_year", "order_month", "ship_year", "is_train"]
M13_SQL = f"""WITH {FACTS_CTE},
a AS (SELECT count(*) AS n, {', '.join(f'count({c}) AS v{i}' for i, c in enumerate(M13_ALL))} FROM facts)
{rows_sql('a', [('not_empty', None, 'n > 0', 'n'), ('missing_columns', None, 'false', "'SalePrice'"),
                ('extra_columns', None, 'true', "'" + ','.join(c for c in M13_ALL if c not in M13_REQ) + "'")]
          + [('not_all_null', c, f'v{i} > 0 OR n = 0', f'v{i}') for i, c in enumerate(M13_ALL)])}"""


@register("m13_frame_validation", M13_SQL)
def m13_frame_validation(spark, d):
    return qa.frame_validation(order_facts(spark, d), M13_REQ)


# ---------------------------------------------------------------- M14
M14_SQL = f"""WITH {FACTS_CTE},
a AS (SELECT {', '.join(f"sum(CASE WHEN {c} IS NULL {'OR isnan(' + c + ')' if dbl else ''} THEN 1 ELSE 0 END) AS n{i}"
                         for i, (c, dbl) in enumerate(M06_COLS))} FROM facts),
r AS ({rows_sql('a', [('nulls', c, f'n{i} = 0', f'n{i}') for i, (c, _) in enumerate(M06_COLS)])}),
t AS (SELECT count(*) AS n FROM facts),
r2 AS ({rows_sql('t', [('row_count', None, 'true', "CAST(n AS VARCHAR) || '->' || CAST(n AS VARCHAR)")])}),
u AS (SELECT * FROM r UNION ALL SELECT * FROM r2)
SELECT * FROM u
UNION ALL
SELECT 'stage_gate', 'stage1', bool_and(passed), CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS VARCHAR) FROM u"""


@register("m14_stage_gate", M14_SQL)
def m14_stage_gate(spark, d):
    f = order_facts(spark, d)
    checks = [qa.null_counts(f, [c for c, _ in M06_COLS]), qa.row_count_consistency(f, f)]
    return qa.stage_gate(checks, "stage1")
