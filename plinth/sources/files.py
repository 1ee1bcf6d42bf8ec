"""Sources and sinks: stage tables, CSV/JSON inputs, prediction files and logs.

Paths are plain strings (local, HDFS or object store).  Scratch output goes
under the session's ``spark.checkpoint.dir`` (see :func:`plinth.session.scratch_path`).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.operators.clean import NA_TOKENS
from plinth.operators.features import col
from plinth.sources.commit_log import CommitLog

STAGES = range(1, 9)


class StageError(ValueError):
    pass


# ---------------------------------------------------------------- A01
def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str, key: str | None = None,
                   na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Header CSV with an explicit schema (no inference); every text NA token becomes
    NULL (the reader's ``nullValue`` takes only one token)."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(*na_tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name)
        out.append(c)
    df = df.select(*out)
    if key:
        df = df.select(col(key), *[col(c) for c in df.columns if c != key])
    return df


# ---------------------------------------------------------------- A02-A04
def stage_path(base: str, stage: int, train: bool = True) -> str:
    if stage not in STAGES:
        raise StageError(f"stage must be in 1..8, got {stage}")
    return f"{base.rstrip('/')}/stage{stage}/{'train' if train else 'test'}"


def save_stage(df: DataFrame, base: str, stage: int, train: bool = True) -> str:
    """Write a stage table (Parquet, overwrite); the write cuts the lineage."""
    p = stage_path(base, stage, train)
    df.write.mode("overwrite").parquet(p)
    return p


def load_stage(spark: SparkSession, base: str, stage: int, train: bool = True, check_empty: bool = True) -> DataFrame:
    """Read a stage table; errors for a stage out of range, a missing or an empty table."""
    p = stage_path(base, stage, train)
    try:
        df = spark.read.parquet(p)
    except AnalysisException as e:
        raise FileNotFoundError(f"stage {stage} ({'train' if train else 'test'}) not found at {p}") from e
    if check_empty and df.isEmpty():
        raise StageError(f"stage {stage} table at {p} is empty")
    return df


def load_pair(spark: SparkSession, base: str, stage: int) -> tuple[DataFrame, DataFrame]:
    """The train/test pair of a stage."""
    return load_stage(spark, base, stage, True), load_stage(spark, base, stage, False)


# ---------------------------------------------------------------- A05 / A14
def read_prediction_files(spark: SparkSession, root: str, key: str = "Id", value: str = "SalePrice",
                          pattern: str = "*.csv") -> DataFrame:
    """Every CSV below ``root``; the model name is the parent folder; files whose header
    lacks ``key`` or ``value`` are skipped.  Long result ``(model, key, value)``.

    A file's header is its first line.  Files are grouped by header (a scan of first lines only decides
    the groups) and each group is read by the CSV reader, so quoted fields and any data line count; a
    value that is no number becomes NULL.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    first = (files.text(root).where("_metadata.file_block_start = 0")
             .select(F.col("value"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_at"))
             .groupBy("path").agg(F.min_by("value", "_at").alias("header")))
    # one row per layout; the file names are those the driver has listed anyway
    layouts = first.groupBy("header").agg(F.collect_list("path").alias("paths")).orderBy("header").collect()
    parts = []
    for layout in layouts:
        rows = spark.read.option("header", True).csv(layout["paths"])
        if key in rows.columns and value in rows.columns:
            model = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
            parts.append(rows.select(F.url_decode(model).alias("model"), col(key).try_cast("long").alias(key),
                                     col(value).try_cast("double").alias(value)))
    if not parts:
        return spark.createDataFrame([], f"model string, `{key}` long, `{value}` double")
    return reduce(DataFrame.unionByName, parts)


def predictions_wide(long: DataFrame, key: str = "Id", value: str = "SalePrice",
                     models: Sequence[str] | None = None) -> DataFrame:
    """Long predictions -> one column per model (pivot values listed when known)."""
    g = long.groupBy(col(key))
    p = g.pivot("model", list(models)) if models else g.pivot("model")
    # two rows for a key and model are an error, not a choice
    one = F.when(F.count(F.lit(1)) <= 1, F.first(col(value))).otherwise(
        F.raise_error(F.lit("more than one prediction for a key and model")).cast("double"))
    return p.agg(one)


def list_prediction_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """Prediction files with a display model name (folder name without a numeric prefix,
    underscores as spaces, title case).  ``binaryFile`` with only ``path`` selected reads no
    file content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
             .load(root).select("path", "length", "modificationTime"))
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    display = F.initcap(F.regexp_replace(F.regexp_replace(folder, r"^\d+_", ""), "_", " "))
    return files.select("path", folder.alias("folder"), display.alias("display_name"), "length", "modificationTime")


# ---------------------------------------------------------------- A06 / A07
class SubmissionError(ValueError):
    pass


def create_submission(preds: DataFrame, ids: DataFrame, key: str = "Id", pred: str = "pred",
                      log_space: bool = True, validate: bool = True, out_key: str = "Id",
                      out_value: str = "SalePrice") -> DataFrame:
    """``(Id, SalePrice)`` for every id; ``expm1`` when predictions are in log space.
    Validation (one aggregate): every id predicted exactly once, no NULL/NaN/Inf, all > 0."""
    j = ids.select(col(key), F.lit(True).alias("_want")).join(preds.select(col(key), col(pred)), key, "full")
    v = F.expm1(col(pred)) if log_space else col(pred)
    sub = j.where("_want").select(col(key).alias(out_key), v.alias(out_value))
    if validate:
        r = sub.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(col(out_key)).alias("nk"),
                    F.sum(F.when(col(out_value).isNull() | F.isnan(col(out_value))
                                 | (F.abs(col(out_value)) == float("inf")), 1).otherwise(0)).alias("bad"),
                    F.sum(F.when(col(out_value) <= 0, 1).otherwise(0)).alias("nonpos")).first()
        ids_n, surplus = ids.select(key).count(), j.where("_want IS NULL").count()
        if surplus:
            raise SubmissionError(f"length mismatch: {surplus} predictions for ids that were not asked for")
        if r["n"] != ids_n or r["nk"] != r["n"]:
            raise SubmissionError(f"length mismatch: {r['n']} predictions ({r['nk']} distinct ids) for {ids_n} ids")
        if r["bad"]:
            raise SubmissionError(f"{r['bad']} missing or non-finite predictions")
        if r["nonpos"]:
            raise SubmissionError(f"{r['nonpos']} predictions are <= 0")
    return sub


def write_submission(sub: DataFrame, path: str) -> str:
    sub.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_sample_submission(spark: SparkSession, path: str, required: Sequence[str] = ("Id", "SalePrice")) -> DataFrame:
    """Template ids; raises when a required column is missing."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SubmissionError(f"sample submission lacks columns {missing}")
    return df.select(col(required[0]).cast("long").alias(required[0]),
                     *[col(c) for c in df.columns if c != required[0]])


# ---------------------------------------------------------------- A10
def manifest_upsert(manifest: DataFrame, updates: DataFrame, key: str = "stage", version: str = "version") -> DataFrame:
    """A10: key-overwrite: the entry with the highest ``version`` per key wins."""
    u = manifest.unionByName(updates, allowMissingColumns=True)
    latest = u.groupBy(col(key)).agg(F.max_by(F.struct(*[col(c) for c in u.columns if c != key]), col(version)).alias("_r"))
    return latest.select(col(key), "_r.*")


def manifest_reset(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A10: an empty manifest."""
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------- A11
def read_json_log(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON array file (multi-line) -> one row per entry."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def json_log(spark: SparkSession, path: str, schema: T.StructType | str) -> CommitLog:
    """The submission log kept in the JSON array file ``path``, which is only read; new entries lie in a
    commit log beside it."""
    return CommitLog(spark, f"{path.rstrip('/')}.log", fmt="json", base=path, base_schema=schema)


def append_json_log(spark: SparkSession, path: str, schema: T.StructType | str, entries: DataFrame, txn: str | None = None) -> DataFrame:
    """Append entries (missing columns added) to the log of ``path`` and return all its entries."""
    log = json_log(spark, path, schema)
    log.append(entries, txn)
    return log.read()


# ---------------------------------------------------------------- A12
#: Bytes of a file that a task holds at a time.
CHUNK_BYTES = 4 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = []
        for path in batch.column(0).to_pylist():
            store, at = (fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)) if path.startswith("file:") else fs.FileSystem.from_uri(path)
            state = hashlib.md5(usedforsecurity=False)
            with store.open_input_stream(at) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    state.update(chunk)
            hashes.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hashes, pa.string())], ["path", "length", "hash"])


def fingerprint_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(name, path, length, hash) of every file: MD5 of its content.

    The listing reads no content; tasks stream the files chunk by chunk and carry the MD5 state on, so
    memory does not depend on a file's size.  Spark lists no empty files.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
             .load(root).select("path", "length"))
    dealt = files.repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    out = dealt.mapInArrow(_digests, "path string, length long, hash string")
    return out.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path", "length", "hash")


def already_submitted(current: DataFrame, log: DataFrame, name: str = "name", hash_col: str = "hash",
                      order: str = "timestamp") -> DataFrame:
    """A file counts as submitted when the LATEST log entry with its name has the same
    hash, or that entry has no hash; a changed file is not submitted."""
    latest = log.groupBy(col(name)).agg(F.max_by(col(hash_col), col(order)).alias("_lh"),
                                        F.max(col(order)).alias("_lt"))
    j = current.join(latest, name, "left")
    sub = F.when(F.col("_lt").isNull(), F.lit(False)).when(F.col("_lh").isNull(), F.lit(True)) \
        .otherwise(F.col("_lh") == col(hash_col))
    return j.select(*[col(c) for c in current.columns], sub.alias("submitted"))


def md5_text(c: Column) -> Column:
    return F.md5(c.cast("string"))


