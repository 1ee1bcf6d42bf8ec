"""Decisions by distinct counts without shuffling the values of every column.

``count_distinct`` of several columns expands each row once per column and shuffles every value.  Here one pass of HLL
sketches estimates all columns; only columns whose estimate is too near the limit are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch (as a power of two) and the relative error that it is trusted to (six standard deviations).
LOG_REGISTERS = 14
TRUSTED = 6 * 1.04 / 2 ** (LOG_REGISTERS / 2)


def estimates(df: DataFrame, cols: Sequence[str]) -> tuple[int, dict[str, float]]:
    """(rows, estimated distinct values of each column without NULL), in one map-side combined pass."""
    if not cols:
        return df.count(), {}
    # a sketch takes longs, strings and binaries; a hash of the value serves every type
    sketch = lambda c: F.hll_sketch_agg(F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))), F.lit(LOG_REGISTERS))
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.hll_sketch_estimate(sketch(c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return row["n"], {c: float(row[f"c{i}"] or 0) for i, c in enumerate(cols)}


def few_values(df: DataFrame, cols: Sequence[str], most: int) -> dict[str, int]:
    """The exact distinct count (without NULL) of every column that has at most ``most`` values.

    Only columns estimated near or below ``most`` are collected, so no set is larger than about that.
    """
    _, guess = estimates(df, cols)
    near = [c for c in cols if guess[c] <= most * (1 + 2 * TRUSTED) + 8]
    if not near:
        return {}
    row = df.agg(*[F.size(F.collect_set(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(near)]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(near) if row[f"c{i}"] <= most}


def many_values(df: DataFrame, cols: Sequence[str], least_share: float) -> list[str]:
    """The columns whose distinct values (without NULL) are more than ``least_share`` of the rows."""
    n, guess = estimates(df, cols)
    line = least_share * n
    near = [c for c in cols if abs(guess[c] - line) <= TRUSTED * max(guess[c], line) + 8]
    exact = {}
    if near:
        row = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(near)]).first()
        exact = {c: row[f"c{i}"] for i, c in enumerate(near)}
    return [c for c in cols if exact.get(c, guess[c]) > line]
