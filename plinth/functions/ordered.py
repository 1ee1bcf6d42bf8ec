"""Global ordering without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition key runs in ONE task.
Here the table is range-partitioned on the sort key (a sampled, balanced
split), each partition is sorted locally, and the row's position inside its
partition (the low bits of ``monotonically_increasing_id``) is added to the
number of rows in all earlier partitions (a table with one row per partition).
The order must be total (end with a unique column) so ties cannot reorder
between recomputations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.sizing import hold


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """Range partitions for a global sort: at least the shuffle setting, and one for every
    ``RANGE_BYTES`` of the sources that the optimised plan reads (a 100 TB input gets hundreds of
    thousands of ranges, not 200).  Only the plan is looked at; nothing runs."""
    if partitions:
        return partitions
    conf = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = [s for s in sizes if s < 1 << 60]  # a source of unknown size estimates the largest number
    return max(conf, sum(known) // RANGE_BYTES)


RANGE_BYTES = 128 << 20


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` column numbering rows in ``order`` across the whole table."""
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    p = _partitions(df, partitions)
    ranged = (
        df.repartitionByRange(p, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = hold(ranged)  # read twice: once for the partition counts, once for the rows
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    # one row per partition: a window over this tiny table is fine
    before = F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_pid", F.coalesce(before, F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + pos + 1).drop("_pid", "_mid", "_off")


# Rows per contiguous chunk of the global order.  A chunk is the unit a window
# runs over, so no window partition ever exceeds this many rows, however large
# one key's share of the table is.
CHUNK_ROWS = 1_000_000


def chunk_order(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], chunk_rows: int = CHUNK_ROWS,
                partitions: int | None = None) -> DataFrame:
    """Global row number ``_rn`` over ``by + order`` and its chunk ``_chunk``."""
    ranked = global_row_number(df, [*[F.col(b) for b in by], *order], "_rn", partitions)
    return ranked.withColumn("_chunk", F.floor((F.col("_rn") - 1) / chunk_rows).cast("long"))


def previous_row(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], cols: Sequence[str],
                 prefix: str = "prev_", chunk_rows: int = CHUNK_ROWS, partitions: int | None = None) -> DataFrame:
    """``lag(col)`` within ``by`` ordered by ``order``, without a per-key window.

    ``lag`` runs within bounded chunks of the global order; the row before a chunk's first comes
    from a table with one row per chunk.  It counts as the previous row when it has the same
    ``by`` values, so a key holding a third of the table is spread over all tasks.
    """
    from plinth.functions.sizing import broadcast_if_small

    r = chunk_order(df, by, order, chunk_rows, partitions)
    row = F.struct(*[F.col(b).alias(f"b{i}") for i, b in enumerate(by)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    w = Window.partitionBy("_chunk").orderBy("_rn")
    edge = r.groupBy("_chunk").agg(F.max_by(row, "_rn").alias("_edge")).withColumn("_chunk", F.col("_chunk") + 1)
    j = r.withColumn("_prev", F.lag(row).over(w)).join(broadcast_if_small(edge), "_chunk", "left") \
        .withColumn("_prev", F.coalesce("_prev", "_edge"))
    same = F.col("_prev").isNotNull()
    for i, b in enumerate(by):
        same = same & F.col(f"_prev.b{i}").eqNullSafe(F.col(b))
    return j.select(*[F.col(c) for c in df.columns],
                    *[F.when(same, F.col(f"_prev.c{i}")).alias(f"{prefix}{c}") for i, c in enumerate(cols)])


def running_extreme(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str, how: str = "min",
                    inclusive: bool = False, name: str = "running", chunk_rows: int = CHUNK_ROWS,
                    partitions: int | None = None) -> DataFrame:
    """Running min/max of ``value`` over earlier rows (``inclusive`` adds the current row).

    Windows run per chunk of the global order (bounded size); the carry-in from
    earlier chunks comes from a table with one row per (chunk, key).
    """
    agg = F.min if how == "min" else F.max
    comb = F.least if how == "min" else F.greatest
    r = chunk_order(df, by, order, chunk_rows, partitions)
    w = Window.partitionBy("_chunk", *by).orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    r = r.withColumn("_within", agg(F.col(value)).over(w))
    per = r.groupBy("_chunk", *by).agg(agg(F.col(value)).alias("_cagg"))
    wc = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select("_chunk", *by, agg("_cagg").over(wc).alias("_carry"))
    from plinth.functions.sizing import broadcast_if_small
    j = r.join(broadcast_if_small(carry), ["_chunk", *by], "left")
    return j.withColumn(name, comb(F.col("_within"), F.col("_carry"))).drop("_within", "_carry", "_chunk", "_rn")


def asof_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], ts: str, left_id: str, right_id: str,
                 chunk_rows: int = CHUNK_ROWS, partitions: int | None = None) -> DataFrame:
    """For every ``right`` row, the ``left`` row with the same ``by`` values nearest in ``ts``.

    Both sides are unioned and numbered in ``(by, ts)`` order; within each chunk a
    window finds the last left row before and the first left row after each right
    row, and a one-row-per-chunk table carries them across chunk borders.  The
    nearer one wins; on equal distance the earlier one.  No pairs are formed.
    Returns ``right_id, left_id, diff_us`` (left_id NULL when the key has no left rows).
    """
    from plinth.functions.sizing import broadcast_if_small
    lsel = left.select(*by, F.col(ts).alias("_t"), F.col(left_id).cast("long").alias("_lid"),
                       F.lit(None).cast("long").alias("_rid"), F.lit(0).alias("_kind"))
    rsel = right.select(*by, F.col(ts).alias("_t"), F.lit(None).cast("long").alias("_lid"),
                        F.col(right_id).cast("long").alias("_rid"), F.lit(1).alias("_kind"))
    u = lsel.unionByName(rsel)
    r = chunk_order(u, by, [F.col("_t"), F.col("_kind"), F.col("_lid"), F.col("_rid")], chunk_rows, partitions)
    info = F.when(F.col("_kind") == 0, F.struct(F.unix_micros(F.col("_t").cast("timestamp")).alias("t"), F.col("_lid").alias("id")))
    # both directions use growing frames (O(n)); an UNBOUNDED FOLLOWING frame would
    # re-aggregate the tail for every row (O(n^2))
    wp = Window.partitionBy("_chunk", *by).orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
    wn = Window.partitionBy("_chunk", *by).orderBy(F.desc("_rn")).rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_pin", F.last(info, ignorenulls=True).over(wp)).withColumn(
        "_nin", F.last(info, ignorenulls=True).over(wn))
    lrn = F.when(F.col("_kind") == 0, F.col("_rn"))
    per = r.groupBy("_chunk", *by).agg(F.max_by(info, lrn).alias("_last"), F.min_by(info, lrn).alias("_first"))
    wcp = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    wcn = Window.partitionBy(*by).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select("_chunk", *by, F.last("_last", ignorenulls=True).over(wcp).alias("_pc"),
                       F.last("_first", ignorenulls=True).over(wcn).alias("_nc"))
    rr = r.where(F.col("_kind") == 1).join(broadcast_if_small(carry), ["_chunk", *by], "left")
    prev = F.coalesce(F.col("_pin"), F.col("_pc"))
    nxt = F.coalesce(F.col("_nin"), F.col("_nc"))
    t = F.unix_micros(F.col("_t").cast("timestamp"))
    dp, dn = t - prev["t"], nxt["t"] - t
    take_prev = nxt.isNull() | (prev.isNotNull() & (dp <= dn))
    return rr.select(F.col("_rid").alias(right_id),
                     F.when(take_prev, prev["id"]).otherwise(nxt["id"]).alias(left_id),
                     F.when(take_prev, dp).otherwise(dn).alias("diff_us"))
