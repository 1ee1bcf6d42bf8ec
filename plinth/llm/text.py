"""Whole texts as byte arrays: words, spans and hashes of an Arrow string column by NumPy.

Every helper takes one Arrow batch of documents and works on all its bytes; a null text counts as
empty.  ``chunks`` bounds how many bytes are expanded at once (a longer text is a chunk of its own).
"""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1_000_000
#: Bytes of text that a stage of the pipeline works on at a time; it needs some 50 times as much for a moment.
FILTER_BYTES = 250_000
#: Bytes of an Arrow batch of documents between the JVM and a Python worker; each side holds one or two a task.
BATCH_BYTES = 4 << 20
#: Powers are kept in multiples of this number, 16 bytes each.
POWERS = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_LANES = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def worker_path(spark) -> None:
    """Let Python workers import this package also when the driver's working folder is another one, and bound the bytes of
    the batches that they are sent (the session's bound on their rows lets whole documents add up)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, root) if x)


def small_side(keys: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A join side of a few numbers a row: broadcast if it has at most ``most`` rows (some 30 MB), else shuffled."""
    return F.broadcast(keys) if keys.count() <= most else keys


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most`` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def give_back() -> None:
    """Return freed memory of this process to the system; the allocators keep it for later otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def releasing(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches that gives memory back when its task ends: a worker lives on from stage to stage."""

    @functools.wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            give_back()

    return run


def releasing_group(rows: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of one group that gives memory back after each group."""

    @functools.wraps(rows)
    def run(group: pa.Table) -> pa.Table:
        try:
            return rows(group)
        finally:
            give_back()

    return run


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; nulls are empty."""
    col = pc.fill_null(col, "")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers[0].size < n:
        n = -(-n // POWERS) * POWERS
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: differences of one running polynomial."""
    power, inverse = _power(buf.size + 1)
    run = np.empty(buf.size + 1, np.uint64)
    run[0] = 0
    np.cumsum(_BYTE[buf] * power[: buf.size], out=run[1:])
    return mix((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Texts:
    """The texts of a batch in one buffer, a space before each; words are [^\\x20\\x09-\\x0D]+.

    ``first[i]:first[i + 1]`` are the words of text i, ``begin[i]:end[i]`` its bytes in ``buf``.
    """

    def __init__(self, col: pa.Array, lower: bool = False):
        data, off = column_bytes(col)
        self.n = len(off) - 1
        self.buf = np.concatenate([np.insert(data, off[:-1], 32), np.full(1, 32, np.uint8)])
        if lower:
            self.buf = LOWER[self.buf]
        self.begin = off[:-1] + np.arange(1, self.n + 1)
        self.end = off[1:] + np.arange(1, self.n + 1)
        self._split(~SPACE[self.buf])

    def _split(self, inside: np.ndarray) -> None:
        step = np.diff(inside.view(np.int8))
        self.starts = np.flatnonzero(step == 1) + 1
        self.ends = np.flatnonzero(step == -1) + 1
        self.first = np.append(np.searchsorted(self.starts, self.begin), self.starts.size)
        self.words = np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.words)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends)


def windows(h: np.ndarray, first: np.ndarray, k: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's windows of ``k`` words, with the bounds of each text's windows.

    ``whole``: a text of 1 to k-1 words gives its whole sequence as one window.
    """
    n = np.diff(first)
    count = np.maximum(n - k + 1, 0)
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    out = np.zeros(at.size, np.uint64)
    for j in range(k):
        out += h[at + j] * _LANES[j]
    out = mix(out + np.uint64(k))
    if whole and (short := np.flatnonzero((n > 0) & (n < k))).size:
        own = np.zeros(short.size, np.uint64)
        for j in range(k - 1):
            own += np.where(n[short] > j, h[np.minimum(first[short] + j, h.size - 1)] * _LANES[j], np.uint64(0))
        own = mix(own + n[short].astype(np.uint64))
        where = np.cumsum(count)[short]
        out = np.insert(out, where, own)
        count = count.copy()
        count[short] = 1
    return out, np.concatenate([[0], np.cumsum(count)])


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each segment ``bounds[i]:bounds[i + 1]``; an empty segment gives 0."""
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return run[bounds[1:]] - run[bounds[:-1]]


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
