"""Queries for fold assignment (I01-I05) and out-of-fold target encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.operators import folds as fo
from plinth.operators import target_encode as te
from plinth.plans.catalog import register
from plinth.plans.common import filled, round_doubles
from plinth.plans.facts import FILLED_CTE


def HASH(seed: int) -> str:
    return f"(((okey % 2147483648) * 1103515245 + 12345 + {seed}) % 2147483648)"


FOLDED_CTE = FILLED_CTE + f""",
fz AS (SELECT *, CAST({HASH(42)} % 5 AS INTEGER) AS fold FROM filled),
tr AS (SELECT * FROM fz WHERE is_train),
te AS (SELECT * FROM fz WHERE NOT is_train)"""


def split_folded(spark, d):
    f = fo.kfold(filled(spark, d), "okey", 5, 42)
    return f.where("is_train"), f.where("NOT is_train")


# ---------------------------------------------------------------- I01
I01_SQL = f"WITH {FILLED_CTE} SELECT okey, CAST({HASH(42)} % 5 AS INTEGER) AS fold FROM filled"


@register("i01_kfold", I01_SQL)
def i01_kfold(spark, d):
    return fo.kfold(filled(spark, d), "okey", 5, 42).select("okey", "fold")


# ---------------------------------------------------------------- I02
def _strat_sql(seed: int, with_repeat: int | None = None) -> str:
    rep = f", {with_repeat} AS repeat" if with_repeat is not None else ""
    return f"""SELECT okey, bin, CAST((rn2 - 1 - bin * (n // 10)) % 5 AS INTEGER) AS fold{rep} FROM (
  SELECT b.*, row_number() OVER (ORDER BY bin, h, okey) AS rn2 FROM (
    SELECT r1.*, CAST(least(floor((rn1 - 1) / (n // 10)), 9) AS INTEGER) AS bin, {HASH(seed)} AS h
    FROM (SELECT okey, y, row_number() OVER (ORDER BY y, okey) AS rn1 FROM filled) r1 CROSS JOIN cnt
  ) b
) r2 CROSS JOIN cnt"""


I02_SQL = f"WITH {FILLED_CTE}, cnt AS (SELECT count(*) AS n FROM filled) " + _strat_sql(42)


@register("i02_stratified_kfold", I02_SQL)
def i02_stratified_kfold(spark, d):
    f = filled(spark, d).select("okey", "y")
    out = fo.stratified_kfold(f, "okey", "y", 5, 10, 42, keep_bin=True)
    return out.select("okey", F.col("_bin").alias("bin"), "fold")


# ---------------------------------------------------------------- I03
def _group_sql(group: str) -> str:
    return f"""WITH {FILLED_CTE},
sizes AS (SELECT {group}, count(*) AS n FROM filled GROUP BY {group}),
r AS (SELECT {group}, row_number() OVER (ORDER BY n DESC, {group}) - 1 AS r FROM sizes),
t AS (SELECT {group}, CAST(CASE WHEN CAST(floor(r / 5) AS BIGINT) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS INTEGER) AS fold
      FROM r)
SELECT f.okey, t.fold FROM filled f LEFT JOIN t ON t.{group} = f.{group}"""


@register("i03_group_kfold", _group_sql("nation"))
def i03_group_kfold(spark, d):
    return fo.group_kfold(filled(spark, d), "nation", 5).select("okey", "fold")


# ---------------------------------------------------------------- I04
I04_SQL = f"WITH {FILLED_CTE}, cnt AS (SELECT count(*) AS n FROM filled) " + " UNION ALL ".join(
    f"SELECT okey, fold, repeat FROM ({_strat_sql(42 + r, r)})" for r in range(3))


@register("i04_repeated_stratified", I04_SQL)
def i04_repeated_stratified(spark, d):
    f = filled(spark, d).select("okey", "y")
    return fo.repeated_stratified(f, "okey", "y", 5, 3, 10, 42).select("okey", "fold", "repeat")


# ---------------------------------------------------------------- I05
@register("i05_cv_dispatch", _group_sql("segment"))
def i05_cv_dispatch(spark, d):
    return fo.cv_strategy(filled(spark, d), "group", key="okey", group="segment", k=5).select("okey", "fold")


@register("i05_cv_dispatch_kfold", I01_SQL)
def i05_cv_dispatch_kfold(spark, d):
    return fo.cv_strategy(filled(spark, d), "kfold", key="okey", k=5, seed=42).select("okey", "fold")


@register("i05_cv_dispatch_stratified", I02_SQL)
def i05_cv_dispatch_stratified(spark, d):
    f = filled(spark, d).select("okey", "y")
    out = fo.cv_strategy(f, "stratified", key="okey", target="y", k=5, seed=42, n_bins=10, keep_bin=True)
    return out.select("okey", F.col("_bin").alias("bin"), "fold")


@register("i05_cv_dispatch_repeated", I04_SQL)
def i05_cv_dispatch_repeated(spark, d):
    f = filled(spark, d).select("okey", "y")
    return fo.cv_strategy(f, "repeated", key="okey", target="y", k=5, seed=42, repeats=3, n_bins=10).select("okey", "fold", "repeat")


# ---------------------------------------------------------------- H01
def _te_sql(cat: str, target: str = "y", src_tr: str = "tr", src_te: str = "te", name: str | None = None) -> str:
    name = name or f"{cat}_TargetEnc"
    return f"""
g_{cat} AS (SELECT avg({target}) AS g FROM {src_tr}),
per_{cat} AS (SELECT {cat}, fold, sum({target}) AS s, count({target}) AS c FROM {src_tr} GROUP BY {cat}, fold),
tot_{cat} AS (SELECT {cat}, sum({target}) AS s, count({target}) AS c FROM {src_tr} GROUP BY {cat}),
oof_{cat} AS (SELECT p.{cat}, p.fold, t.s - p.s AS so, t.c - p.c AS co FROM per_{cat} p JOIN tot_{cat} t ON t.{cat} = p.{cat}),
enc_{cat} AS (
  SELECT x.okey, round(CASE WHEN o.co > 0 THEN (o.so + g.g) / (o.co + 1.0) ELSE g.g END, 6) AS {name}
  FROM {src_tr} x LEFT JOIN oof_{cat} o ON o.{cat} = x.{cat} AND o.fold = x.fold CROSS JOIN g_{cat} g
  UNION ALL
  SELECT x.okey, round(coalesce((t.s + g.g) / (t.c + 1.0), g.g), 6)
  FROM {src_te} x LEFT JOIN tot_{cat} t ON t.{cat} = x.{cat} CROSS JOIN g_{cat} g
)"""


H01_SQL = f"WITH {FOLDED_CTE}, {_te_sql('nation')} SELECT * FROM enc_nation"


@register("h01_oof_target_encode", H01_SQL)
def h01_oof_target_encode(spark, d):
    tr, tst = split_folded(spark, d)
    a, b = te.oof_target_encode(tr, tst, "nation", "y")
    return round_doubles(a.select("okey", "nation_TargetEnc").unionByName(b.select("okey", "nation_TargetEnc")))


# ---------------------------------------------------------------- H02
H02_SQL = f"""WITH {FOLDED_CTE}, {_te_sql('nation')}, {_te_sql('segment')}, {_te_sql('priority')}
SELECT okey, nation_TargetEnc, segment_TargetEnc, priority_TargetEnc
FROM enc_nation JOIN enc_segment USING (okey) JOIN enc_priority USING (okey)"""


@register("h02_encode_many", H02_SQL)
def h02_encode_many(spark, d):
    tr, tst = split_folded(spark, d)
    cols = ["nation", "segment", "priority", "Neighborhood"]
    a, b = te.encode_many(tr, tst, cols, "y")
    out = ["okey", "nation_TargetEnc", "segment_TargetEnc", "priority_TargetEnc"]
    return round_doubles(a.select(*out).unionByName(b.select(*out)))


# ---------------------------------------------------------------- H03
H03_CTE = f"""{FOLDED_CTE},
gs AS (SELECT avg(y) AS gm, stddev_samp(y) AS gsd, median(y) AS gmed FROM tr),
rep AS (SELECT tr.nation, tr.y, ff.ff FROM tr CROSS JOIN (SELECT unnest(range(5)) AS ff) ff WHERE ff.ff <> tr.fold),
pf AS (SELECT nation, ff, avg(y) AS mean, median(y) AS median, stddev_samp(y) AS std, min(y) AS min, max(y) AS max
       FROM rep GROUP BY nation, ff),
full_s AS (SELECT nation, avg(y) AS mean, median(y) AS median, stddev_samp(y) AS std, min(y) AS min, max(y) AS max
           FROM tr GROUP BY nation),
h03 AS (
  SELECT x.okey, coalesce(p.mean, gs.gm) AS m1, coalesce(p.median, gs.gmed) AS m2,
         coalesce(p.std, gs.gsd) AS m3, coalesce(p.min, gs.gsd) AS m4, coalesce(p.max, gs.gsd) AS m5
  FROM tr x LEFT JOIN pf p ON p.nation = x.nation AND p.ff = x.fold CROSS JOIN gs
  UNION ALL
  SELECT x.okey, coalesce(p.mean, gs.gm), coalesce(p.median, gs.gmed), coalesce(p.std, gs.gsd),
         coalesce(p.min, gs.gsd), coalesce(p.max, gs.gsd)
  FROM te x LEFT JOIN full_s p ON p.nation = x.nation CROSS JOIN gs
)"""

H03_SQL = f"""WITH {H03_CTE}
SELECT okey, round(m1, 6) AS nation_mean_y, round(m2, 6) AS nation_median_y, round(m3, 6) AS nation_std_y,
       round(m4, 6) AS nation_min_y, round(m5, 6) AS nation_max_y FROM h03"""

H03_COLS = ["okey", "nation_mean_y", "nation_median_y", "nation_std_y", "nation_min_y", "nation_max_y"]


def h03_frames(spark, d):
    tr, tst = split_folded(spark, d)
    return te.oof_group_stats(tr, tst, "nation", "y", 5)


@register("h03_oof_group_stats", H03_SQL)
def h03_oof_group_stats(spark, d):
    a, b = h03_frames(spark, d)
    return round_doubles(a.select(*H03_COLS).unionByName(b.select(*H03_COLS)))


# ---------------------------------------------------------------- H04
H04_SQL = f"""WITH {FOLDED_CTE}, trr AS (SELECT *, y / (sum_qty + 1) AS ry FROM tr),
{_te_sql('nation', 'ry', 'trr', 'te', 'nation_PricePerSF_TargetEnc')}
SELECT * FROM enc_nation"""


@register("h04_ratio_target_encode", H04_SQL)
def h04_ratio_target_encode(spark, d):
    tr, tst = split_folded(spark, d)
    a, b = te.ratio_target_encode(tr, tst, "nation", "y", "sum_qty")
    c = "nation_PricePerSF_TargetEnc"
    return round_doubles(a.select("okey", c).unionByName(b.select("okey", c)))


# ---------------------------------------------------------------- H05
H05_SQL = f"""WITH {H03_CTE}
SELECT h03.okey, round(m1 * f.n_lines, 6) AS Neighborhood_x_Qual, round(m1 * f.sum_qty, 6) AS Neighborhood_x_Size,
       round(m1 * (f.ship_year - f.order_year), 6) AS Neighborhood_x_Age
FROM h03 JOIN filled f ON f.okey = h03.okey"""


@register("h05_stat_interactions", H05_SQL)
def h05_stat_interactions(spark, d):
    a, b = h03_frames(spark, d)
    both = a.unionByName(b).withColumn("Age", F.col("ship_year") - F.col("order_year"))
    out = te.stat_interactions(both, "nation_mean_y", {"Neighborhood_x_Qual": "n_lines",
                                                       "Neighborhood_x_Size": "sum_qty", "Neighborhood_x_Age": "Age"})
    return round_doubles(out.select("okey", "Neighborhood_x_Qual", "Neighborhood_x_Size", "Neighborhood_x_Age"))
