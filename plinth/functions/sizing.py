"""Join-side sizing: broadcast a side only when its row count is proven small."""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows below which a parameter table (group stats, encodings, bounds) is shipped
# to every executor instead of shuffling the large side.  Parameter rows are a
# few dozen bytes, so this stays far below the executor memory.
BROADCAST_MAX_ROWS = 2_000_000


_held = threading.local()


def hold(df: DataFrame) -> DataFrame:
    """Cache an intermediate of the running query; :func:`release_held` frees it later."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if not hasattr(_held, "frames"):
        _held.frames = []
    _held.frames.append(df)
    return df


def release_held() -> None:
    """Free what this thread's earlier queries cached through :func:`hold` (no other caches)."""
    for df in getattr(_held, "frames", []):
        df.unpersist()
    _held.frames = []


#: Bytes of a side that may be broadcast, by its estimated row width.
BROADCAST_MAX_BYTES = 200 << 20


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes of a row: its type's default sizes, 64 for a string."""
    width = {"string": 64, "binary": 64, "boolean": 1, "int": 4, "float": 4}
    return 16 + sum(width.get(t, 8 if "<" not in t else 256) for _, t in df.dtypes)


def broadcast_if_small(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, bound: int | None = None) -> DataFrame:
    """Broadcast ``small`` if it has at most ``max_rows`` rows and its estimated size (rows by
    row width) stays below ``BROADCAST_MAX_BYTES``, else return it as is.

    ``bound``: a row count already known to the caller (e.g. the size of the table the
    side was filtered from) -- no job is run then.  Otherwise the side is persisted and
    counted once, so the join reuses the computed rows instead of recomputing the
    aggregate.  Beyond the bound the planner's shuffle join (with AQE skew splitting)
    is used instead.
    """
    max_rows = min(max_rows, BROADCAST_MAX_BYTES // row_bytes(small))
    if bound is not None and bound <= max_rows:
        return F.broadcast(small)
    kept = hold(small)
    if kept.count() <= max_rows:
        return F.broadcast(kept)
    kept.unpersist()
    return small
