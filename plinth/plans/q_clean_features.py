"""Queries for cleaning, profiling and row-wise features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators import clean
from plinth.operators import features as fe
from plinth.plans.catalog import register
from plinth.plans.common import filled, round_doubles
from plinth.plans.facts import FACTS_CTE, FILLED_CTE, order_facts, table

FILLED_OUT = ("okey", "status", "priority", "y", "n_lines", "sum_qty", "sum_price", "avg_disc", "segment",
              "nation", "acctbal", "order_year", "order_month", "ship_year", "is_train")

# Ordinal maps used on the order data (the house data uses fe.QUALITY_SCALE).
PRIORITY_SCALE = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}
STATUS_SCALE = {"F": 2, "O": 1}

SCORED_CTE = FILLED_CTE + """,
scored AS (
  SELECT *,
    CAST(CASE priority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
                       WHEN '5-LOW' THEN 1 ELSE 0 END AS TINYINT) AS priority_Score,
    CAST(CASE status WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS TINYINT) AS status_Score,
    ship_year - order_year AS Age
  FROM filled
)"""


def scored(spark, d) -> DataFrame:
    f = filled(spark, d)
    f = fe.with_columns(f, [("priority_Score", fe.col("priority")), ("status_Score", fe.col("status"))])
    f = fe.ordinal_scores(f, ["priority_Score"], PRIORITY_SCALE, suffix="")
    f = fe.ordinal_scores(f, ["status_Score"], STATUS_SCALE, suffix="")
    return fe.with_columns(f, [("Age", F.col("ship_year") - F.col("order_year"))])


# ---------------------------------------------------------------- B01
B01_SQL = f"WITH {FILLED_CTE} SELECT {', '.join(FILLED_OUT)} FROM filled"


@register("b01_fill_missing", B01_SQL)
def b01_fill_missing(spark, d):
    return filled(spark, d).select(*FILLED_OUT)


# ---------------------------------------------------------------- B02
PROFILE_COLS = [("status", "s"), ("priority", "s"), ("n_lines", "n"), ("segment", "s"), ("nation", "s"),
                ("order_year", "n"), ("order_month", "n"), ("sum_qty", "n"), ("acctbal", "n")]


def _profile_sql() -> str:
    parts = []
    for c, kind in PROFILE_COLS:
        vals = f"array_to_string(list_transform(list_sort(list(DISTINCT {c})), lambda v: CAST(v AS VARCHAR)), ', ')"
        if kind == "n":
            typ = f"CASE WHEN count(DISTINCT {c}) <= 15 THEN 'numeric (discrete)' ELSE 'numeric (continuous)' END"
        else:
            typ = "'categorical'"
        parts.append(
            f"SELECT '{c}' AS \"column\", {typ} AS type, count(DISTINCT {c}) AS n_unique, "
            f"CASE WHEN count(DISTINCT {c}) <= 15 THEN {vals} "
            f"ELSE CAST(count(DISTINCT {c}) AS VARCHAR) || ' unique values' END AS unique_values FROM facts"
        )
    return f"WITH {FACTS_CTE} " + " UNION ALL ".join(parts)


@register("b02_column_profile", _profile_sql())
def b02_column_profile(spark, d):
    f = order_facts(spark, d).select(*[c for c, _ in PROFILE_COLS])
    return clean.column_profile(f, max_unique=15)


# ---------------------------------------------------------------- B03
B03_SQL = f"""WITH {FACTS_CTE}
SELECT okey, is_train FROM facts
WHERE NOT (is_train AND coalesce(sum_qty > 250 AND y < 10, false))"""


@register("b03_remove_outliers", B03_SQL)
def b03_remove_outliers(spark, d):
    f = order_facts(spark, d)
    return clean.remove_outliers(f, (F.col("sum_qty") > 250) & (F.col("y") < 10)).select("okey", "is_train")


# ---------------------------------------------------------------- B04
B04_SQL = """SELECT o_orderkey AS okey, round(o_totalprice, 6) AS target, round(ln(1 + o_totalprice), 6) AS target_log1p,
       round(sqrt(o_totalprice), 6) AS target_sqrt FROM orders"""


@register("b04_target_variants", B04_SQL)
def b04_target_variants(spark, d):
    o = table(spark, d, "orders")
    return round_doubles(o.select(F.col("o_orderkey").alias("okey"),
                                  *[c.alias(n) for n, c in fe.target_variants(F.col("o_totalprice"))]))


# ---------------------------------------------------------------- B07
B07_SQL = f"""WITH {FILLED_CTE}
SELECT okey, ship_year - order_year AS Age, ship_year - order_month AS Month_Age FROM filled"""


@register("b07_age_features", B07_SQL)
def b07_age_features(spark, d):
    f = filled(spark, d)
    specs = fe.age_features("ship_year", {"Age": "order_year", "Month_Age": "order_month"})
    return f.select("okey", *[c.alias(n) for n, c in specs])


# ---------------------------------------------------------------- B08
B08_SQL = f"""WITH {FACTS_CTE}
SELECT okey, round(coalesce(sum_qty, 0) + coalesce(n_lines, 0) * 0.5 + coalesce(avg_disc, 0), 6) AS TotalUnits,
       round(coalesce(sum_price, 0) + coalesce(acctbal, 0), 6) AS TotalValue FROM facts"""


@register("b08_null_safe_sums", B08_SQL)
def b08_null_safe_sums(spark, d):
    f = order_facts(spark, d)
    specs = [fe.null_safe_sum("TotalUnits", {"sum_qty": 1, "n_lines": 0.5, "avg_disc": 1}),
             fe.null_safe_sum("TotalValue", {"sum_price": 1, "acctbal": 1})]
    return round_doubles(f.select("okey", *[c.alias(n) for n, c in specs]))


# ---------------------------------------------------------------- B09
B09_SQL = f"""WITH {SCORED_CTE}
SELECT okey, CAST(floor(order_year / 10) * 10 AS BIGINT) AS Decade,
       CAST(floor(Age / 10) * 10 AS BIGINT) AS AgeDecade FROM scored"""


@register("b09_decade", B09_SQL)
def b09_decade(spark, d):
    s = scored(spark, d)
    return s.select("okey", *[c.alias(n) for n, c in [fe.decade("order_year"), fe.decade("Age", "AgeDecade")]])


# ---------------------------------------------------------------- B10
B10_SQL = f"""WITH {FACTS_CTE}
SELECT okey, CASE WHEN n_lines > 0 THEN 1 ELSE 0 END AS HasLines,
       CASE WHEN avg_disc > 0 THEN 1 ELSE 0 END AS HasDiscount,
       CASE WHEN acctbal > 0 THEN 1 ELSE 0 END AS HasCredit, 0 AS HasPool,
       CASE WHEN priority = '1-URGENT' THEN 1 ELSE 0 END AS IsUrgent, 1 AS IsNormalCondition
FROM facts"""


@register("b10_presence_flags", B10_SQL)
def b10_presence_flags(spark, d):
    f = order_facts(spark, d)
    specs = fe.presence_flags(f, {"HasLines": "n_lines", "HasDiscount": "avg_disc", "HasCredit": "acctbal",
                                  "HasPool": "PoolArea"})
    specs += [fe.equality_flag(f, "IsUrgent", "priority", "1-URGENT"),
              fe.equality_flag(f, "IsNormalCondition", "Condition1", "Norm")]
    return f.select("okey", *[c.alias(n) for n, c in specs])


# ---------------------------------------------------------------- B11
B11_SQL = f"""WITH {SCORED_CTE} SELECT okey, priority_Score, status_Score FROM scored"""


@register("b11_ordinal_scores", B11_SQL)
def b11_ordinal_scores(spark, d):
    return scored(spark, d).select("okey", "priority_Score", "status_Score")


# ---------------------------------------------------------------- B12
B12_SQL = f"""WITH {SCORED_CTE}
SELECT okey, round(priority_Score * sum_qty, 6) AS Qual_x_TotalSF, round(3 * sum_qty, 6) AS Kitchen_x_TotalSF,
       status_Score * Age AS Cond_x_Age FROM scored"""


@register("b12_basic_interactions", B12_SQL)
def b12_basic_interactions(spark, d):
    s = scored(spark, d)
    kitchen = ("Kitchen_x_TotalSF", fe.col("KitchenQual_Score") * fe.col("sum_qty")) if "KitchenQual_Score" in s.columns \
        else ("Kitchen_x_TotalSF", F.lit(3) * fe.col("sum_qty"))
    specs = fe.products([("Qual_x_TotalSF", "priority_Score", "sum_qty")], s) + [kitchen] + \
        fe.products([("Cond_x_Age", "status_Score", "Age")], s)
    return round_doubles(s.select("okey", *[c.alias(n) for n, c in specs]))


# ---------------------------------------------------------------- B13
B13_SQL = f"""WITH {FILLED_CTE}
SELECT okey, round(sum_qty * sum_qty, 6) AS sum_qty_squared, n_lines * n_lines AS n_lines_squared,
       round(acctbal * acctbal, 4) AS acctbal_squared FROM filled"""


@register("b13_squares", B13_SQL)
def b13_squares(spark, d):
    f = filled(spark, d)
    out = f.select("okey", *[c.alias(n) for n, c in fe.squares(f, ["sum_qty", "n_lines", "acctbal", "GarageArea"])])
    return round_doubles(out).withColumn("acctbal_squared", F.round("acctbal_squared", 4))


# ---------------------------------------------------------------- B14
B14_SQL = f"""WITH {FILLED_CTE}, x AS (SELECT *, n_lines - 1 AS lines_m1 FROM filled)
SELECT okey,
  round(coalesce(CASE WHEN sum_qty + 1 = 0 THEN NULL ELSE sum_price / (sum_qty + 1) END, 0), 6) AS price_per_qty,
  round(coalesce(CASE WHEN lines_m1 + 1 = 0 THEN NULL ELSE acctbal / (lines_m1 + 1) END, 0), 6) AS acct_per_line,
  round(coalesce(CASE WHEN lines_m1 + 1 = 0 THEN NULL ELSE avg_disc / (lines_m1 + 1) END, 0), 6) AS disc_per_line
FROM x"""


@register("b14_safe_ratios", B14_SQL)
def b14_safe_ratios(spark, d):
    f = fe.with_columns(filled(spark, d), [("lines_m1", F.col("n_lines") - 1)])
    specs = fe.ratios_plus_one([("price_per_qty", "sum_price", "sum_qty"), ("acct_per_line", "acctbal", "lines_m1"),
                                ("disc_per_line", "avg_disc", "lines_m1"), ("skipped", "LotArea", "TotalSF")], f)
    return round_doubles(f.select("okey", *[c.alias(n) for n, c in specs]))


# ---------------------------------------------------------------- B15
B15_SQL = f"""WITH {SCORED_CTE}, x AS (SELECT *, CAST(floor(order_year / 10) * 10 AS BIGINT) AS Decade FROM scored)
SELECT okey, ship_year - 1992 AS YearsSince1992, CAST(((ship_year - 1992) % 4 + 4) % 4 AS INTEGER) AS MarketCycle,
  CASE WHEN ship_year >= 1997 THEN 1 ELSE 0 END AS PostCrisis,
  CAST(floor((order_month - 1) / 3) + 1 AS BIGINT) AS Quarter,
  CASE WHEN order_month >= 3 AND order_month <= 8 THEN 1 ELSE 0 END AS PeakSeason,
  CASE WHEN order_month >= 11 OR order_month <= 1 THEN 1 ELSE 0 END AS EndOfYear,
  round(sin(2 * pi() * order_month / 12), 6) + 0.0 AS MonthSin, round(cos(2 * pi() * order_month / 12), 6) + 0.0 AS MonthCos,
  Age AS RemodAge_AtSale, Age * CAST(((ship_year - 1992) % 4 + 4) % 4 AS INTEGER) AS RemodAge_x_MarketCycle,
  ship_year - order_year AS Age_AtSale, Decade * (ship_year - order_year) AS Decade_x_AgeAtSale
FROM x"""


@register("b15_temporal_features", B15_SQL)
def b15_temporal_features(spark, d):
    s = scored(spark, d)
    s = fe.with_columns(s, [fe.decade("order_year")])
    specs = fe.temporal_features("ship_year", "order_month", age="Age", decade_col="Decade", built="order_year",
                                 base_year=1992, era_year=1997)
    return round_doubles(s.select("okey", *[c.alias(n) for n, c in specs]))


# ---------------------------------------------------------------- B16
B16_SQL = f"""WITH {SCORED_CTE}
SELECT okey,
  round((priority_Score + status_Score + n_lines) / 3.0, 6) AS AvgQuality,
  greatest(priority_Score, status_Score, n_lines) AS MaxQuality,
  least(priority_Score, status_Score, n_lines) AS MinQuality,
  greatest(priority_Score, status_Score, n_lines) - least(priority_Score, status_Score, n_lines) AS QualityRange,
  (CASE WHEN priority_Score >= 4 THEN 1 ELSE 0 END) + (CASE WHEN status_Score >= 4 THEN 1 ELSE 0 END)
    + (CASE WHEN n_lines >= 4 THEN 1 ELSE 0 END) AS ExcellentFeatures,
  (CASE WHEN priority_Score <= 2 THEN 1 ELSE 0 END) + (CASE WHEN status_Score <= 2 THEN 1 ELSE 0 END)
    + (CASE WHEN n_lines <= 2 THEN 1 ELSE 0 END) AS PoorFeatures
FROM scored"""


@register("b16_quality_aggregates", B16_SQL)
def b16_quality_aggregates(spark, d):
    s = scored(spark, d)
    score_cols = [c for c in s.columns if "_Score" in c] + ["n_lines"]
    return round_doubles(s.select("okey", *[c.alias(n) for n, c in fe.quality_aggregates(score_cols)]))


# ---------------------------------------------------------------- B17/B18
B17_PAIRS = [("Qty_x_Disc", "sum_qty", "avg_disc"), ("Lines_x_Priority", "n_lines", "priority_Score"),
             ("Acct_x_Status", "acctbal", "status_Score"), ("Age_x_Lines", "Age", "n_lines"),
             ("Pool_x_Qual", "PoolArea", "OverallQual")]
B17_SQL = f"""WITH {SCORED_CTE}
SELECT okey, round(sum_qty * avg_disc, 6) + 0.0 AS Qty_x_Disc, n_lines * priority_Score AS Lines_x_Priority,
  round(acctbal * status_Score, 6) + 0.0 AS Acct_x_Status, Age * n_lines AS Age_x_Lines FROM scored"""


@register("b17_pair_interactions", B17_SQL)
def b17_pair_interactions(spark, d):
    s = scored(spark, d)
    return round_doubles(s.select("okey", *[c.alias(n) for n, c in fe.products(B17_PAIRS, s)]))


B18_SQL = f"""WITH {SCORED_CTE}
SELECT okey, round(sum_qty * avg_disc * priority_Score, 6) AS Qty_Disc_Priority,
  n_lines * status_Score * priority_Score AS Lines_Status_Priority,
  round(coalesce(CASE WHEN n_lines + 1 = 0 THEN NULL ELSE sum_price / (n_lines + 1) END, 0), 6) AS Price_Efficiency
FROM scored"""


@register("b18_triple_interactions", B18_SQL)
def b18_triple_interactions(spark, d):
    s = scored(spark, d)
    specs = fe.triple_products([("Qty_Disc_Priority", "sum_qty", "avg_disc", "priority_Score"),
                                ("Lines_Status_Priority", "n_lines", "status_Score", "priority_Score"),
                                ("Neighborhood_x_Quality", "Neighborhood_QualityScore", "n_lines", "Age")], s)
    specs += fe.ratios_plus_one([("Price_Efficiency", "sum_price", "n_lines")], s)
    return round_doubles(s.select("okey", *[c.alias(n) for n, c in specs]))


# ---------------------------------------------------------------- B19
B19_SQL = f"""WITH {FACTS_CTE}
SELECT okey, n_lines * (ship_year - order_year) AS Qual_Age_Interaction,
  order_month - order_year AS RemodAge_FromBuild,
  CASE WHEN ship_year IS NOT NULL AND order_year IS NOT NULL AND ship_year = order_year THEN 0 ELSE 1 END AS Is_Remodeled,
  n_lines * n_lines AS n_lines_Squared FROM facts"""


@register("b19_error_driven", B19_SQL)
def b19_error_driven(spark, d):
    f = order_facts(spark, d)
    specs = fe.error_driven(f, "n_lines", "ship_year", "order_year", "order_month")
    specs = [(n, c) for n, c in specs if n != "Is_Remodeled"]
    specs.insert(2, fe.error_driven(f, "n_lines", "ship_year", "order_year", "ship_year")[2])
    return f.select("okey", *[c.alias(n) for n, c in specs])


# ---------------------------------------------------------------- B20-B23
B20_SQL = f"""WITH {FACTS_CTE}, flags AS (
  SELECT okey, CASE WHEN n_lines > 0 THEN 1 ELSE 0 END AS HasLines, CASE WHEN avg_disc > 0 THEN 1 ELSE 0 END AS HasDiscount,
         CASE WHEN acctbal > 0 THEN 1 ELSE 0 END AS HasCredit FROM facts)
SELECT okey, HasLines + HasDiscount + HasCredit AS LuxuryFeatureCount, HasLines * HasDiscount * HasCredit AS PremiumLuxury
FROM flags"""


@register("b20_luxury_count", B20_SQL)
def b20_luxury_count(spark, d):
    f = order_facts(spark, d)
    flags = fe.presence_flags(f, {"HasLines": "n_lines", "HasDiscount": "avg_disc", "HasCredit": "acctbal"})
    f = fe.with_columns(f, flags)
    return f.select("okey", *[c.alias(n) for n, c in fe.luxury_count(["HasLines", "HasDiscount", "HasCredit"])])


B21_SQL = f"""WITH {FILLED_CTE}
SELECT okey, round(coalesce(sum_qty / (n_lines + 1), 0), 6) + 0.0 AS LivingArea_per_Bedroom,
       round(coalesce(sum_price / (acctbal + 1), 0), 6) + 0.0 AS LotUtilization FROM filled"""


@register("b21_utilisation_ratios", B21_SQL)
def b21_utilisation_ratios(spark, d):
    f = filled(spark, d)
    specs = fe.ratios_plus_one([("LivingArea_per_Bedroom", "sum_qty", "n_lines"), ("LotUtilization", "sum_price", "acctbal")])
    return round_doubles(f.select("okey", *[c.alias(n) for n, c in specs]))


B22_SQL = f"""WITH {SCORED_CTE}
SELECT okey, round((2.0 * n_lines + 1.5 * order_month + 1.0 * priority_Score + 1.0 * status_Score) / (5.5 + 1e-10), 6)
  AS WeightedQualityScore FROM scored"""


@register("b22_weighted_quality", B22_SQL)
def b22_weighted_quality(spark, d):
    s = scored(spark, d)
    w = fe.weight_table(s.columns, {"n_lines": 2.0, "order_month": 1.5}, fe.SCORE_WEIGHTS)
    return round_doubles(s.select("okey", fe.weighted_row_mean("WeightedQualityScore", w)[1].alias("WeightedQualityScore")))


B23_SQL = f"""WITH {SCORED_CTE}
SELECT okey,
  CASE WHEN (CASE WHEN ship_year = order_year THEN 0 ELSE 1 END) = 1 AND ship_year >= 1998 THEN 1 ELSE 0 END AS RecentRemodel,
  round(n_lines * sum_qty, 6) AS Class_x_TotalSF, n_lines * priority_Score AS Class_x_Quality
FROM scored"""


@register("b23_class_interactions", B23_SQL)
def b23_class_interactions(spark, d):
    s = scored(spark, d)
    s = fe.with_columns(s, [fe.error_driven(s, "n_lines", "ship_year", "order_year", "ship_year")[2]])
    specs = [fe.recent_remodel("Is_Remodeled", "ship_year", 1998)]
    specs += fe.products([("Class_x_TotalSF", "n_lines", "sum_qty"), ("Class_x_Quality", "n_lines", "priority_Score"),
                          ("MSZoning_x_Neighborhood", "MSZoning_TargetEnc", "Neighborhood_QualityScore")], s)
    return round_doubles(s.select("okey", *[c.alias(n) for n, c in specs]))


# ---------------------------------------------------------------- B26
B26_SQL = """SELECT event_id, TRY_CAST(regexp_extract(props, '"k": (\\w+)', 1) AS DOUBLE) AS k_num,
  TRY_CAST(CASE WHEN event_type = 'error' THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) IS NULL AS ts_invalid
FROM events"""


@register("b26_coercion", B26_SQL)
def b26_coercion(spark, d):
    ev = table(spark, d, "events")
    raw = ev.select("event_id", F.regexp_extract("props", r'"k": (\w+)', 1).alias("k_num"),
                    F.when(F.col("event_type") == "error", F.lit("not a time"))
                    .otherwise(F.col("ts").cast("string")).alias("ts_text"))
    out = clean.coerce_timestamp(clean.coerce_numeric(raw, ["k_num"]), ["ts_text"])
    return out.select("event_id", "k_num", F.col("ts_text").isNull().alias("ts_invalid"))


# ---------------------------------------------------------------- B30
B30_SQL = f"""WITH {FILLED_CTE}
SELECT okey, custkey, round(y, 6) AS y, n_lines, sum_qty, sum_price, round(avg_disc, 6) AS avg_disc, acctbal,
       order_year, order_month, ship_year FROM filled"""


@register("b30_numeric_only", B30_SQL)
def b30_numeric_only(spark, d):
    return round_doubles(clean.keep_numeric(filled(spark, d)))
