"""Quality rules: exact text counts and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed byte n-grams of the whole texts: the trusted target
(documents labelled good) and the raw corpus (all documents).  The target is smoothed towards the raw
distribution, so an n-gram about which the target says nothing counts as 0.  A document's score is the
mean ratio of its n-grams (so length does not matter), and one fixed threshold decides every document.

Counting is one pass in which each task sends one row per used bucket; the ratio table has
``2 ** BITS`` entries whatever the input, so it can be sent to every task.

Defined results: a null or empty text has no words and fails the base rules; without any target
document the ratio is 0 everywhere and only the base rules decide; an empty table gives an empty
result; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.text import FILTER_BYTES, SPACE, Texts, chunks, field, releasing, small_side, span_hashes, sums, windows

GRAM = 5
BITS = 17
#: Mean log ratio below which a document is rejected.
THRESHOLD = -0.15
#: Weight of the raw distribution in the target, in n-grams per bucket.
PRIOR = 1.0
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, score double, kept boolean")


def gram_buckets(buf: np.ndarray, gram: int = GRAM, bits: int = BITS) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte of ``buf``."""
    n = max(buf.size - gram + 1, 0)
    h = np.zeros(n, np.uint32)
    for j in range(gram):
        h *= np.uint32(0x01000193)
        h ^= buf[j : j + n]
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - bits)


def _bounds(t: Texts, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last n-gram position of each text (n-grams that lie within it)."""
    return t.begin, np.maximum(t.end - gram + 1, t.begin)


def count_grams(docs: DataFrame, gram: int = GRAM, bits: int = BITS) -> DataFrame:
    """(bucket, raw, target) over all rows of (text, trusted boolean)."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in chunks(batches):
            t = Texts(field(batch, "text"))
            bucket = gram_buckets(t.buf, gram, bits)
            lo, hi = _bounds(t, gram)
            good = field(batch, "trusted").to_numpy(zero_copy_only=False).astype(bool)
            for counts, chosen in ((raw, np.ones(t.n, bool)), (target, good)):
                edge = np.zeros(bucket.size + 1, np.int32)
                np.add.at(edge, np.minimum(lo[chosen], bucket.size), 1)
                np.add.at(edge, np.minimum(hi[chosen], bucket.size), -1)
                counts += np.bincount(bucket[np.cumsum(edge[:-1]) > 0], minlength=size)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
                                         ["bucket", "raw", "target"])

    parts = docs.mapInArrow(releasing(count), "bucket int, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratio(counts: DataFrame, bits: int = BITS, prior: float = PRIOR) -> np.ndarray:
    """log(target / raw) per bucket; reads ``2 ** bits`` rows at most."""
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    got = counts.toPandas()
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    share = raw / max(raw.sum(), 1)
    weight = prior * (1 << bits)
    out = np.zeros(1 << bits, np.float32)
    used = share > 0
    out[used] = np.log((target[used] + weight * share[used]) / (target.sum() + weight) / share[used])
    return out


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, trusted): all documents, marked where the labels call them good."""
    good = small_side(labels.where("quality = 1").select(F.col("doc_id").alias("_good_id")).distinct())
    return (docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("_good_id"), "left")
            .select("text", F.col("_good_id").isNotNull().alias("trusted")))


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The ratio table of a corpus and its labels."""
    return log_ratio(count_grams(trusted_rows(docs, labels)))


def _repeated_words(t: Texts, k: int) -> np.ndarray:
    """Per text: the words that lie in a window of ``k`` words found twice or more in the text."""
    win, at = windows(t.hashes(), t.first, k, whole=False)
    if not win.size:
        return np.zeros(t.n, np.int64)
    owner = np.repeat(np.arange(t.n), np.diff(at))
    order = np.lexsort((win, owner))
    same = (win[order][1:] == win[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(win.size, bool)
    twice[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    # the window's first word: its place among the windows of its text, counted from the text's first word
    start = (t.first[owner] + np.arange(win.size) - at[owner])[twice]
    edge = np.zeros(t.starts.size + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + k, -1)
    return sums((np.cumsum(edge[:-1]) > 0).astype(np.int64), t.first)


def _repeated_lines(t: Texts) -> np.ndarray:
    """Per text: the \\n-split lines with a word that are equal to an earlier line."""
    cut = t.buf == 10
    breaks = np.flatnonzero(cut)
    starts = np.concatenate([t.begin, breaks + 1])
    ends = np.concatenate([t.end, breaks])
    starts.sort()
    ends.sort()
    owner = np.searchsorted(t.begin, starts, "right") - 1
    inside = np.concatenate([[0], np.cumsum(~SPACE[t.buf])])
    full = inside[ends] > inside[starts]
    starts, ends, owner = starts[full], ends[full], owner[full]
    h = span_hashes(t.buf, starts, ends)
    order = np.lexsort((h, owner))
    again = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][1:][again], minlength=t.n).astype(np.int64)


def measure(col: pa.Array, ratio: np.ndarray, threshold: float = THRESHOLD) -> dict[str, np.ndarray]:
    """All figures of the texts of one batch."""
    t = Texts(col)
    inside = ~SPACE[t.buf]
    lead = inside & ((t.buf & 0xC0) != 0x80)
    byte_bounds = np.append(t.begin, t.buf.size)
    count = lambda mask: sums(mask.astype(np.int64), byte_bounds)
    bits = int(ratio.size - 1).bit_length()
    value = ratio[gram_buckets(t.buf, GRAM, bits)].astype(np.float64)
    lo, hi = _bounds(t, GRAM)
    run = np.concatenate([[0.0], np.cumsum(value)])
    lo, hi = np.minimum(lo, value.size), np.minimum(hi, value.size)
    score = np.where(hi > lo, (run[hi] - run[lo]) / np.maximum(hi - lo, 1), 0.0)
    words = t.words.astype(np.int64)
    repeat = _repeated_words(t, WINDOW)
    failed = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
    return {"n_words": words, "word_chars": count(lead), "n_symbols": count(_SYMBOL[t.buf]),
            "n_dup_lines": _repeated_lines(t), "n_repeat_words": repeat, "base_failed": failed,
            "score": score, "kept": ~failed & (score >= threshold)}


def quality_rules(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` with its counts, score and verdict."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            got = measure(field(batch, "text"), ratio, threshold)
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), *map(pa.array, got.values())], ["doc_id", *got])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SCHEMA)


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    ratio = fit(docs, labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=FILTER_BYTES):
            yield batch.filter(pa.array(measure(field(batch, "text"), ratio, threshold)["kept"]))

    return docs.mapInArrow(releasing(rows), docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
