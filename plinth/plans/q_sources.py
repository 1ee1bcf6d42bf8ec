"""Queries for sources and sinks.

Each query writes data derived from the test tables under the shared scratch
folder, reads it back through the operator and returns the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.plans.catalog import register
from plinth.plans.common import filled, round_doubles
from plinth.plans.facts import FILLED_CTE, table
from plinth.plans.q_evaluate import MODELS, PREDS_CTE, wide_predictions
from plinth.session import scratch_path
from plinth.sources import files as fs
from plinth.sources.commit_log import CommitLog

CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"

# ---------------------------------------------------------------- A01
A01_SQL = """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 100 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer"""


@register("a01_read_csv", A01_SQL)
def a01_read_csv(spark, d):
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_acctbal") < 0, F.lit("NA")).when(F.col("c_acctbal") < 100, F.lit("")) \
        .otherwise(F.col("c_mktsegment"))
    path = scratch_path(spark, "csv")
    c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", seg.alias("c_mktsegment")) \
        .write.option("header", True).csv(path)
    return fs.read_csv_table(spark, path, CUSTOMER_SCHEMA, key="c_custkey")


# ---------------------------------------------------------------- A02-A04
A02_SQL = f"WITH {FILLED_CTE} SELECT okey, is_train, round(y, 6) AS y, n_lines FROM filled"


@register("a02_stage_roundtrip", A02_SQL)
def a02_stage_roundtrip(spark, d):
    f = filled(spark, d).select("okey", "is_train", "y", "n_lines")
    base = scratch_path(spark, "stages")
    fs.save_stage(f.where("is_train"), base, 2, True)
    fs.save_stage(f.where("NOT is_train"), base, 2, False)
    tr, te = fs.load_pair(spark, base, 2)
    return round_doubles(tr.unionByName(te))


# ---------------------------------------------------------------- A05 / A14
A05_SQL = f"""WITH {PREDS_CTE}
SELECT w.okey AS Id, {', '.join(f'round(exp({m}) - 1, 2) AS "{i + 1}_{m}"' for i, m in enumerate(MODELS))}
FROM wide w JOIN filled f ON f.okey = w.okey WHERE NOT f.is_train"""


def _write_prediction_files(spark, d) -> str:
    root = scratch_path(spark, "preds")
    w = wide_predictions(spark, d).join(filled(spark, d).where("NOT is_train").select("okey"), "okey", "left_semi")
    for i, m in enumerate(MODELS):
        w.select(F.col("okey").alias("Id"), F.round(F.expm1(m), 2).alias("SalePrice")) \
            .write.option("header", True).csv(f"{root}/{i + 1}_{m}")
    # a file without the required columns is skipped by the reader
    w.select(F.col("okey").alias("row"), F.lit("note").alias("text")).write.option("header", True).csv(f"{root}/notes")
    return root


@register("a05_prediction_files", A05_SQL)
def a05_prediction_files(spark, d):
    root = _write_prediction_files(spark, d)
    long = fs.read_prediction_files(spark, root)
    return fs.predictions_wide(long, "Id", "SalePrice", [f"{i + 1}_{m}" for i, m in enumerate(MODELS)])


_FOLDERS = [f"{i + 1}_{m}" for i, m in enumerate(MODELS)] + ["notes"]
A14_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{x}', '{x.lstrip('0123456789').lstrip('_').replace('_', ' ').title()}')" for x in _FOLDERS) + ") t(folder, display_name)"


@register("a14_prediction_file_listing", A14_SQL)
def a14_prediction_file_listing(spark, d):
    root = _write_prediction_files(spark, d)
    return fs.list_prediction_files(spark, root).select("folder", "display_name").distinct()


# ---------------------------------------------------------------- A06 / A07
A06_SQL = f"""WITH {PREDS_CTE}
SELECT w.okey AS Id, round(exp(w.pred_nation) - 1, 4) AS SalePrice
FROM wide w JOIN filled f ON f.okey = w.okey WHERE NOT f.is_train"""


@register("a06_create_submission", A06_SQL)
def a06_create_submission(spark, d):
    w = wide_predictions(spark, d)
    ids = filled(spark, d).where("NOT is_train").select("okey")
    sub = fs.create_submission(w.join(ids, "okey", "left_semi").select("okey", F.col("pred_nation").alias("pred")), ids, key="okey")
    fs.write_submission(sub, scratch_path(spark, "submission"))
    return sub.select("Id", F.round("SalePrice", 4).alias("SalePrice"))


A07_SQL = f"""WITH {FILLED_CTE} SELECT okey AS Id, round(exp(y) - 1, 2) AS SalePrice FROM filled WHERE NOT is_train"""


@register("a07_sample_submission", A07_SQL)
def a07_sample_submission(spark, d):
    path = scratch_path(spark, "sample")
    filled(spark, d).where("NOT is_train").select(F.col("okey").alias("Id"), F.round(F.expm1("y"), 2).alias("SalePrice")) \
        .write.option("header", True).csv(path)
    s = fs.load_sample_submission(spark, path)
    return s.select("Id", F.col("SalePrice").cast("double").alias("SalePrice"))


# ---------------------------------------------------------------- A10
A10_SQL = f"""WITH {FILLED_CTE},
m AS (SELECT nation AS stage, 1 AS version, count(*) AS n FROM filled GROUP BY nation),
u AS (SELECT nation AS stage, 2 AS version, count(*) AS n FROM filled WHERE is_train GROUP BY nation HAVING count(*) > 480),
a AS (SELECT * FROM m UNION ALL SELECT * FROM u)
SELECT stage, max(version) AS version, arg_max(n, version) AS n FROM a GROUP BY stage"""


@register("a10_manifest_upsert", A10_SQL)
def a10_manifest_upsert(spark, d):
    f = filled(spark, d)
    m = f.groupBy(F.col("nation").alias("stage")).agg(F.lit(1).alias("version"), F.count(F.lit(1)).alias("n"))
    u = f.where("is_train").groupBy(F.col("nation").alias("stage")).agg(
        F.lit(2).alias("version"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 480)
    return fs.manifest_upsert(m, u)


@register("a10_manifest_log", A10_SQL)
def a10_manifest_log(spark, d):
    """The same upsert through a commit log: the newest commit of a stage counts."""
    f = filled(spark, d)
    log = CommitLog(spark, scratch_path(spark, "manifest"), key="stage")
    m = f.groupBy(F.col("nation").alias("stage")).agg(F.lit(1).alias("version"), F.count(F.lit(1)).alias("n"))
    u = f.where("is_train").groupBy(F.col("nation").alias("stage")).agg(
        F.lit(2).alias("version"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 480)
    log.append(m)
    log.append(u)
    return log.latest("stage")


# ---------------------------------------------------------------- A11
A11_SQL = """SELECT event_id AS sub_id, event_type AS file, round(value / 100, 6) AS score, 'batch1' AS message FROM events
WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL
SELECT event_id, event_type, round(value / 100, 6), 'batch2' FROM events WHERE ts >= TIMESTAMP '2024-01-16'"""


@register("a11_json_log", A11_SQL)
def a11_json_log(spark, d):
    """The first batch is the array file, the second is appended to its own log in two parts, one of them twice."""
    ev = table(spark, d, "events")
    entry = ev.select(F.col("event_id").alias("sub_id"), F.col("event_type").alias("file"),
                      F.round(F.col("value") / 100, 6).alias("score"), "ts")
    cut = F.lit("2024-01-16").cast("timestamp")
    path = scratch_path(spark, "sublog")
    first = entry.where(F.col("ts") < cut).drop("ts").withColumn("message", F.lit("batch1"))
    arrays = first.groupBy(F.floor(F.col("sub_id") / 10_000).alias("part")).agg(F.to_json(F.collect_list(F.struct(*first.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)  # array files of 10,000 entries at most
    new = entry.where(F.col("ts") >= cut).drop("ts").withColumn("message", F.lit("batch2"))
    schema = "sub_id long, file string, score double, message string"
    log = fs.json_log(spark, path, schema)
    log.append(new.where("sub_id % 2 = 0"), txn="even")
    log.append(new.where("sub_id % 2 = 0"), txn="even")
    return fs.append_json_log(spark, path, schema, new.where("sub_id % 2 <> 0"), txn="odd").select("sub_id", "file", "score", "message")


# ---------------------------------------------------------------- A12
A12_SQL = """WITH cur AS (SELECT doc_id, md5(text) AS hash FROM documents),
log AS (
  SELECT doc_id, 1 AS ts, md5(text) AS hash FROM documents
  UNION ALL
  SELECT doc_id, 2, CASE lang WHEN 'en' THEN md5(text || '#') WHEN 'de' THEN NULL ELSE md5(text) END FROM documents
),
latest AS (SELECT doc_id, arg_max(hash, ts) AS lh, max(ts) AS lt FROM log GROUP BY doc_id)
SELECT c.doc_id, c.hash,
  CASE WHEN l.lt IS NULL THEN false WHEN l.lh IS NULL THEN true ELSE l.lh = c.hash END AS submitted
FROM cur c LEFT JOIN latest l ON l.doc_id = c.doc_id"""


@register("a12_fingerprint_registry", A12_SQL)
def a12_fingerprint_registry(spark, d):
    docs = table(spark, d, "documents")
    cur = docs.select(F.col("doc_id").alias("name"), fs.md5_text(F.col("text")).alias("hash"))
    h2 = F.when(F.col("lang") == "en", F.md5(F.concat("text", F.lit("#")))).when(F.col("lang") == "de", F.lit(None)) \
        .otherwise(F.md5("text"))
    log = docs.select(F.col("doc_id").alias("name"), F.lit(1).alias("timestamp"), F.md5("text").alias("hash")) \
        .unionByName(docs.select(F.col("doc_id").alias("name"), F.lit(2).alias("timestamp"), h2.alias("hash")))
    out = fs.already_submitted(cur, log)
    return out.select(F.col("name").alias("doc_id"), "hash", "submitted")


@register("a12_table_files")
def a12_table_files(spark, d):
    """Fingerprints of the input files themselves; the log's newest entry of a name decides."""
    cur = fs.fingerprint_files(spark, d, "*.parquet").withColumn("file", F.concat_ws("/", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), "name"))
    log = cur.select("file", F.lit(1).alias("timestamp"), "hash").unionByName(
        cur.where(F.col("name").rlike("^[a-m]")).select("file", F.lit(2).alias("timestamp"), F.md5("hash").alias("hash")))
    return fs.already_submitted(cur, log, name="file").select("file", "length", "hash", "submitted")
