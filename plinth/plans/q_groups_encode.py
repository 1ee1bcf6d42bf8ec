"""Queries for group features, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.operators import encode as en
from plinth.operators import groupfeat as gf
from plinth.plans.catalog import register
from plinth.plans.common import filled, round_doubles
from plinth.plans.facts import FILLED_CTE, order_facts
from plinth.plans.q_clean_features import SCORED_CTE, scored

# ---------------------------------------------------------------- D01
D01_CONFIGS = [
    ("nation", "sum_qty", "median"),
    ("nation", "n_lines", "mean"),
    ("nation", "Age", "median"),
    ("segment", "sum_price", "median"),
    ("priority", "acctbal", "median"),
]

D01_SQL = f"""WITH {SCORED_CTE},
train AS (SELECT * FROM scored WHERE is_train),
bn AS (SELECT nation, median(sum_qty) AS sum_qty, median(Age) AS Age FROM train GROUP BY nation),
bm AS (SELECT nation, avg(n_lines) AS n_lines FROM train GROUP BY nation),
bs AS (SELECT segment, median(sum_price) AS sum_price FROM train GROUP BY segment),
bp AS (SELECT priority, median(acctbal) AS acctbal FROM train GROUP BY priority),
g AS (
  SELECT CASE WHEN median(sum_qty) = 0 THEN 1.0 ELSE median(sum_qty) END AS sum_qty,
         CASE WHEN median(Age) = 0 THEN 1.0 ELSE median(Age) END AS Age,
         CASE WHEN avg(n_lines) = 0 THEN 1.0 ELSE avg(n_lines) END AS n_lines,
         CASE WHEN median(sum_price) = 0 THEN 1.0 ELSE median(sum_price) END AS sum_price,
         CASE WHEN median(acctbal) = 0 THEN 1.0 ELSE median(acctbal) END AS acctbal
  FROM train
),
j AS (
  SELECT s.okey, s.sum_qty, s.n_lines, s.Age, s.sum_price, s.acctbal,
    CASE WHEN coalesce(bn.sum_qty, g.sum_qty) = 0 THEN g.sum_qty ELSE coalesce(bn.sum_qty, g.sum_qty) END AS b_qty,
    CASE WHEN coalesce(bm.n_lines, g.n_lines) = 0 THEN g.n_lines ELSE coalesce(bm.n_lines, g.n_lines) END AS b_lines,
    CASE WHEN coalesce(bn.Age, g.Age) = 0 THEN g.Age ELSE coalesce(bn.Age, g.Age) END AS b_age,
    CASE WHEN coalesce(bs.sum_price, g.sum_price) = 0 THEN g.sum_price ELSE coalesce(bs.sum_price, g.sum_price) END AS b_price,
    CASE WHEN coalesce(bp.acctbal, g.acctbal) = 0 THEN g.acctbal ELSE coalesce(bp.acctbal, g.acctbal) END AS b_acct
  FROM scored s LEFT JOIN bn ON bn.nation = s.nation LEFT JOIN bm ON bm.nation = s.nation
  LEFT JOIN bs ON bs.segment = s.segment LEFT JOIN bp ON bp.priority = s.priority CROSS JOIN g
)
SELECT okey,
  round(coalesce(sum_qty / b_qty, 1.0), 6) AS sum_qty_to_nation_Ratio,
  round(coalesce(n_lines / b_lines, 1.0), 6) AS n_lines_to_nation_Ratio,
  round(Age - b_age, 6) AS Age_vs_nation_Avg,
  round(coalesce(sum_price / b_price, 1.0), 6) AS sum_price_to_segment_Ratio,
  round(coalesce(acctbal / b_acct, 1.0), 6) AS acctbal_to_priority_Ratio
FROM j"""


@register("d01_group_benchmarks", D01_SQL)
def d01_group_benchmarks(spark, d):
    s = scored(spark, d)
    (out,) = gf.group_benchmarks(s.where("is_train"), [s], D01_CONFIGS)
    new = [c for c in out.columns if c.endswith("_Ratio") or c.endswith("_Avg")]
    return round_doubles(out.select("okey", *new))


# ---------------------------------------------------------------- D02
D02_SQL = f"""WITH {FILLED_CTE},
m AS (SELECT nation, avg(n_lines) AS n_lines, avg(sum_qty) AS sum_qty, avg(acctbal) AS acctbal
      FROM filled WHERE is_train GROUP BY nation),
g AS (SELECT avg(n_lines) AS n_lines, avg(sum_qty) AS sum_qty, avg(acctbal) AS acctbal FROM filled WHERE is_train),
j AS (
  SELECT f.okey, f.n_lines, f.sum_qty, f.acctbal, coalesce(m.n_lines, g.n_lines) AS mn,
         coalesce(m.sum_qty, g.sum_qty) AS mq, coalesce(m.acctbal, g.acctbal) AS ma
  FROM filled f LEFT JOIN m ON m.nation = f.nation CROSS JOIN g
)
SELECT okey, round(mn, 6) AS n_lines_GroupMean, round(coalesce(n_lines / (mn + 1), 0), 6) AS n_lines_to_GroupMean,
  round(mq, 6) AS sum_qty_GroupMean, round(coalesce(sum_qty / (mq + 1), 0), 6) AS sum_qty_to_GroupMean,
  round(ma, 6) AS acctbal_GroupMean, round(coalesce(acctbal / (ma + 1), 0), 6) AS acctbal_to_GroupMean
FROM j"""


@register("d02_group_means", D02_SQL)
def d02_group_means(spark, d):
    f = filled(spark, d)
    out = gf.group_means(f.where("is_train"), f, "nation", ["n_lines", "sum_qty", "acctbal"])
    return round_doubles(out.select("okey", *[c for c in out.columns if "GroupMean" in c]))


# ---------------------------------------------------------------- C01
C01_COLS = ["n_lines", "sum_qty", "sum_price", "avg_disc", "acctbal", "order_year", "order_month"]
C01_SQL = f"""WITH {FILLED_CTE}, n AS (SELECT count(*) AS n_rows FROM filled)
SELECT * FROM (
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(DISTINCT {c}) FROM filled) AS n_unique, n_rows, "
    f"round((SELECT count(DISTINCT {c}) FROM filled) / n_rows, 6) AS ratio, "
    f"(SELECT count(DISTINCT {c}) FROM filled) / n_rows > 0.05 AS continuous FROM n"
    for c in C01_COLS) + ") t"


@register("c01_continuous_columns", C01_SQL)
def c01_continuous_columns(spark, d):
    f = filled(spark, d).select(*C01_COLS)
    return round_doubles(en.distinct_ratios(f, 0.05))


# ---------------------------------------------------------------- F01
F01_COLS = ["sum_qty", "sum_price", "acctbal", "avg_disc", "n_lines"]
F01_SQL = f"""WITH {FILLED_CTE},
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}' for c in F01_COLS)}
       FROM filled WHERE is_train)
SELECT okey, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) AS {c}' for c in F01_COLS)}
FROM filled CROSS JOIN st"""


@register("f01_standard_scale", F01_SQL)
def f01_standard_scale(spark, d):
    f = filled(spark, d)
    params = en.fit_standard_scaler(f.where("is_train"), F01_COLS)
    return round_doubles(en.apply_standard_scaler(f, params).select("okey", *F01_COLS))


# ---------------------------------------------------------------- F02
F02_SQL = f"""WITH {FILLED_CTE}
SELECT * FROM (
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_levels, "
    f"CASE WHEN count(DISTINCT {c}) <= 10 THEN 'low' ELSE 'high' END AS cardinality FROM filled"
    for c in ("status", "priority", "segment", "nation")) + ") t"


@register("f02_cardinality_split", F02_SQL)
def f02_cardinality_split(spark, d):
    f = filled(spark, d)
    train, test = f.where("is_train"), f.where("NOT is_train")
    cols = ["status", "priority", "segment", "nation"]
    return en.cardinality_table([train.select(*cols), test.select(*cols)], 10)


# ---------------------------------------------------------------- F03
F03_SQL = f"""WITH {FILLED_CTE}
SELECT okey, nation,
  CAST(CASE WHEN status = 'O' THEN 1 ELSE 0 END AS TINYINT) AS status_O,
  CAST(CASE WHEN status = 'P' THEN 1 ELSE 0 END AS TINYINT) AS status_P,
  CAST(CASE WHEN priority = '2-HIGH' THEN 1 ELSE 0 END AS TINYINT) AS "priority_2-HIGH",
  CAST(CASE WHEN priority = '3-MEDIUM' THEN 1 ELSE 0 END AS TINYINT) AS "priority_3-MEDIUM",
  CAST(CASE WHEN priority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS TINYINT) AS "priority_4-NOT SPECIFIED",
  CAST(CASE WHEN priority = '5-LOW' THEN 1 ELSE 0 END AS TINYINT) AS "priority_5-LOW",
  CAST(CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS TINYINT) AS segment_BUILDING,
  CAST(CASE WHEN segment = 'FURNITURE' THEN 1 ELSE 0 END AS TINYINT) AS segment_FURNITURE,
  CAST(CASE WHEN segment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS TINYINT) AS segment_HOUSEHOLD,
  CAST(CASE WHEN segment = 'MACHINERY' THEN 1 ELSE 0 END AS TINYINT) AS segment_MACHINERY
FROM filled"""


@register("f03_one_hot", F03_SQL)
def f03_one_hot(spark, d):
    f = filled(spark, d).select("okey", "is_train", "status", "priority", "segment", "nation")
    train, test = f.where("is_train"), f.where("NOT is_train")
    tr, te = en.one_hot_encode(train, test, 10, exclude=("okey",))
    return tr.unionByName(te).drop("is_train")


# ---------------------------------------------------------------- F04
F04_SQL = f"""WITH {FILLED_CTE},
m AS (SELECT nation, avg(n_lines) AS n_lines, avg(sum_qty) AS sum_qty FROM filled WHERE is_train GROUP BY nation),
g AS (SELECT avg(n_lines) AS n_lines, avg(sum_qty) AS sum_qty FROM filled WHERE is_train),
j AS (
  SELECT f.okey, f.is_train, coalesce(m.n_lines, g.n_lines) AS n_lines_GroupMean,
         coalesce(f.n_lines / (coalesce(m.n_lines, g.n_lines) + 1), 0) AS n_lines_to_GroupMean,
         coalesce(m.sum_qty, g.sum_qty) AS sum_qty_GroupMean,
         coalesce(f.sum_qty / (coalesce(m.sum_qty, g.sum_qty) + 1), 0) AS sum_qty_to_GroupMean
  FROM filled f LEFT JOIN m ON m.nation = f.nation CROSS JOIN g
),
st AS (
  SELECT avg(n_lines_to_GroupMean) AS m1, stddev_pop(n_lines_to_GroupMean) AS s1,
         avg(sum_qty_to_GroupMean) AS m2, stddev_pop(sum_qty_to_GroupMean) AS s2
  FROM j WHERE is_train
)
SELECT okey, round(n_lines_GroupMean, 6) AS n_lines_GroupMean, round(sum_qty_GroupMean, 6) AS sum_qty_GroupMean,
  round((n_lines_to_GroupMean - m1) / CASE WHEN s1 = 0 THEN 1.0 ELSE s1 END, 6) AS n_lines_to_GroupMean,
  round((sum_qty_to_GroupMean - m2) / CASE WHEN s2 = 0 THEN 1.0 ELSE s2 END, 6) AS sum_qty_to_GroupMean
FROM j CROSS JOIN st"""


@register("f04_scale_new_columns", F04_SQL)
def f04_scale_new_columns(spark, d):
    f = filled(spark, d)
    before = f.columns
    f2 = gf.group_means(f.where("is_train"), f, "nation", ["n_lines", "sum_qty"])
    train, test = f2.where("is_train"), f2.where("NOT is_train")
    tr, te, _ = en.scale_new_columns(train, test, before, name_filter=lambda n: "_to_" in n)
    out = tr.unionByName(te)
    return round_doubles(out.select("okey", *[c for c in out.columns if "GroupMean" in c]))


# keep the raw facts importable for callers that profile them
__all__ = ["order_facts"]
