"""Importance resampling: documents are drawn by how much likelier the target model makes them than the raw one.

Both models are multinomials over hashed words and word pairs.  The target is estimated on documents
labelled good (training rows only), the raw model on the whole corpus, and the target is smoothed towards
the raw distribution.  A document's log weight is the sum of the log ratios of its n-grams; adding a
Gumbel variate (from a hash of the seed and the doc_id, so a rerun draws the same) and taking the
largest keys samples without replacement in proportion to the weights.

The k-th largest key is found by counting, 16 bits of the keys' ordered image at a time, so no global
sort is needed.

Defined results: a null or empty text has weight 1 (log 0); documents whose key equals the k-th largest
are all kept; rows repeated with one doc_id have one key; without target rows every log weight is 0; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.graph import written
from plinth.llm.quality import log_ratio
from plinth.llm.text import Texts, chunks, field, mix, small_side, windows

BITS = 16
SEED = 11
SCORED = "doc_id long, n_grams long, log_weight double, gumbel_key double, image long"


def gram_buckets(t: Texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all words and word pairs."""
    h = t.hashes()
    pair, at = windows(h, t.first, 2, whole=False)
    bucket = (np.concatenate([h, pair]) >> np.uint64(64 - bits)).astype(np.int64)
    return bucket, np.concatenate([t.owner(), np.repeat(np.arange(t.n), np.diff(at))])


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def count_grams(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(bucket, raw, target) over all rows of (text, trusted)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in chunks(batches):
            t = Texts(field(batch, "text"), lower=True)
            bucket, text = gram_buckets(t, bits)
            good = field(batch, "trusted").to_numpy(zero_copy_only=False).astype(bool)
            raw += np.bincount(bucket, minlength=1 << bits)
            target += np.bincount(bucket[good[text]], minlength=1 << bits)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
                                         ["bucket", "raw", "target"])

    parts = docs.mapInArrow(count, "bucket int, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> np.ndarray:
    """log(target / raw) of each bucket; the target are training rows with quality 1."""
    good = (labels.where("quality = 1").where(~held_out()).select(F.col("doc_id").alias("_good_id")).distinct())
    rows = (docs.select("doc_id", "text").join(small_side(good), F.col("doc_id") == F.col("_good_id"), "left")
            .select("text", F.col("_good_id").isNotNull().alias("trusted")))
    return log_ratio(count_grams(rows, bits), bits)


def target_share(docs: DataFrame, labels: DataFrame) -> float:
    """The share of good rows among the labelled training rows (1 without any)."""
    known = labels.where(F.col("quality").isNotNull()).where(~held_out())
    got = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    return 1.0 if got is None else float(got)


def gumbel(ids: pa.Array, seed: int = SEED) -> np.ndarray:
    """A standard Gumbel variate for each id (a null id counts as -1)."""
    x = np.nan_to_num(ids.fill_null(-1).to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)
    u = (mix(mix(x + np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(seed)) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2.0**53))


def ordered_image(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = SEED) -> DataFrame:
    """Log weight and Gumbel key of every row."""
    bits = int(ratio.size - 1).bit_length()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            t = Texts(field(batch, "text"), lower=True)
            bucket, text = gram_buckets(t, bits)
            weight = np.bincount(text, weights=ratio[bucket], minlength=t.n)
            key = weight + gumbel(field(batch, "doc_id"), seed)
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), *map(pa.array, (np.bincount(text, minlength=t.n), weight, key, ordered_image(key)))],
                                             [c.split()[0] for c in SCORED.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SCORED)


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a 64-bit column, by four counts over 16 bits each; None beyond the rows."""
    if k <= 0:
        return None
    high, left = 0, k
    for shift in (48, 32, 16, 0):
        part = F.shiftright(F.col(column), shift)
        own = rows if shift == 48 else rows.where(F.shiftright(F.col(column), shift + 16) == F.lit(high))
        for value, n in sorted(map(tuple, own.groupBy(part.alias("v")).count().collect()), reverse=True):
            if left <= n:
                high = value
                break
            left -= n
        else:
            return None
    return high


def resample(docs: DataFrame, ratio: np.ndarray, share: float, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_weight, gumbel_key, kept for every row; ``share`` of the rows are kept."""
    scored = written(docs.sparkSession, weigh(docs, ratio, seed), "weights")
    bar = kth_largest(scored, "image", round(share * scored.count()))
    kept = F.lit(False) if bar is None else F.col("image") >= F.lit(bar)
    return scored.select("doc_id", "n_grams", "log_weight", "gumbel_key", kept.alias("kept"))


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return resample(docs, fit(docs, labels), target_share(docs, labels)).withColumn("held_out", held_out())
