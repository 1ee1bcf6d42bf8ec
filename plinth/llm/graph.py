"""Joins and components that hold when one key or one group has a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.text import releasing
from plinth.session import scratch_path

#: A key with more than this share of the rows is answered by broadcast; there are at most 1 / share of them.
HOT_SHARE = 0.001


#: For tables of a few wide rows: a Parquet writer otherwise holds 100 rows before it closes a page, whatever their bytes.
WIDE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
             "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1"}


def written(spark: SparkSession, rows: DataFrame, name: str, options: dict[str, str] = {}) -> DataFrame:
    """The rows as a table in the shared scratch folder: computed once, lineage cut, safe against lost executors."""
    path = scratch_path(spark, name)
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def answer(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row of ``groups`` a key, whose column ``size`` counts the key's rows.

    Keys with over ``HOT_SHARE`` of the ``total`` rows (at most ``1 / HOT_SHARE`` keys) are joined by
    broadcast, so the rows of a large group stay where they are; all others by a shuffled join.
    """
    least = max(1, int(total * HOT_SHARE))
    hot = F.broadcast(groups.where(F.col(size) > least).drop(size))
    cold = rows.join(F.broadcast(groups.where(F.col(size) > least).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(cold.join(groups.where(F.col(size) <= least).drop(size), keys))


#: Edges that one task contracts at a time.
LOCAL_EDGES = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one partition as stars around the smallest node of each of its components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.get(top, top) != top:
            top = root[top]
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            root.setdefault(u, a)
            root.setdefault(v, b)
            if a != b:
                root[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in root]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, y in pairs if x != y], pa.int64()), pa.array([y for x, y in pairs if x != y], pa.int64())],
                                     ["u", "v"])


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (a, b), for every node of a link.

    Tasks of at most ``LOCAL_EDGES`` edges contract their part to stars.  One such task is the whole
    answer; several are joined by alternating large-star and small-star steps (each one aggregation to
    the smallest neighbour and a join), whose number grows with the logarithm of the longest path.
    Edges are written to the shared folder after every round.
    """
    edges = written(spark, links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "edges")
    mark, n = None, edges.count()
    while True:
        parts = -(-n // LOCAL_EDGES)
        dealt = edges.coalesce(1) if parts <= 1 else edges.repartition(parts, "v")
        edges = dealt.mapInArrow(releasing(_contract), "u long, v long")
        if parts <= 1:
            edges = written(spark, edges, "edges")
            break
        edges = written(spark, _star_steps(edges), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark, n = now, now[0]
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _star_steps(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
