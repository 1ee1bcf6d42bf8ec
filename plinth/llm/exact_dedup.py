"""Exact deduplication against a persistent digest index (DataFrame operations only).

Texts are equal when they are identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted.  The
index is a table bucketed and sorted by digest: one row per text ever accepted.  ``ingest`` groups the
new rows by digest (map-side combined, so a group of copies arrives as one row per task), removes the
digests that the index holds by a sort-merge anti-join and appends the rest.

Defined results: a null text counts as empty, and empty texts are copies of each other; ties in length
go to the smallest doc_id (a null doc_id loses against any other); rows repeated with one doc_id are
one document: they get the same answer, and ``kept_documents`` returns one of them; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.session import scratch_path

BUCKETS = 16
#: Groups with more than this share of the rows are joined by broadcast; there are at most 1 / share of them.
HOT_SHARE = 0.001
_SPACE = " \t\n\x0b\x0c\r"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, n_code): the digest of each normalised text and the length of the original."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.sha2(F.translate(text, _SPACE, ""), 256).alias("text_sha256"),
        F.char_length(text).alias("n_code"),
    )


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the document that stays and the number of copies."""
    best = F.max(F.struct("n_code", (-F.col("doc_id")).alias("minus")))
    return (rows.groupBy("text_sha256").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("text_sha256", (-F.col("best.minus")).alias("keep_id"), "group_size"))


class DigestIndex:
    """The index as a Spark table: ``text_sha256, keep_id, group_size``, bucketed and sorted by digest.

    ``name``: a table of the catalog (created when absent); ``path``: the shared folder of its files.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets
        if not spark.catalog.tableExists(self.name):
            # no rows by an expression: rows from a Python list start further workers on every executor
            empty = spark.range(0).select(F.lit("").alias("text_sha256"), F.col("id").alias("keep_id"), F.col("id").alias("group_size"))
            self._write(empty)

    def _write(self, rows: DataFrame) -> None:
        (rows.write.bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").format("parquet")
         .option("path", self.path).mode("append").saveAsTable(self.name))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Add new documents; returns one row per given row (see ``resolve``).

        A document whose text the index already holds is a copy of the indexed one; among the new
        documents of one text the longest original (then the smallest doc_id) becomes its entry.
        """
        path = scratch_path(self.spark, "digests")
        digests(docs).write.parquet(path)
        rows = self.spark.read.parquet(path)
        new = groups(rows).hint("merge")
        # one file per bucket and ingest: rows reach the writer dealt by the bucket's hash
        fresh = new.join(self.table(), "text_sha256", "left_anti").repartition(self.buckets, "text_sha256")
        self._write(fresh.select("text_sha256", "keep_id", "group_size"))
        self.spark.catalog.refreshTable(self.name)
        return self.resolve(rows)

    def resolve(self, rows: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 of digested rows.

        Texts that make up more than ``HOT_SHARE`` of the rows are answered by a broadcast of at most
        ``1 / HOT_SHARE`` entries, so no task gets all rows of a large group; the rest is a sort-merge join.
        """
        least = max(1, int(rows.count() * HOT_SHARE))
        index = self.table().select("text_sha256", "keep_id", "group_size")
        own = groups(rows).where(F.col("group_size") > least).select("text_sha256")
        hot = F.broadcast(own.join(index, "text_sha256"))
        cold = rows.join(F.broadcast(own), "text_sha256", "left_anti").join(index, "text_sha256")
        out = rows.join(hot, "text_sha256").unionByName(cold)
        return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                          F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Deduplicate ``docs`` against ``index`` (a fresh one if none is given)."""
    return (index or DigestIndex(docs.sparkSession)).ingest(docs)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row per doc_id."""
    return one_row_each(docs, exact_dedup(docs.select("doc_id", "text")).where("kept"))


def one_row_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``kept``, one a doc_id."""
    ids = kept.select(F.col("doc_id").alias("id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]), "left_semi").dropDuplicates(["doc_id"])


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_code,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, count(*) AS group_size, first(doc_id ORDER BY n_code DESC, doc_id) AS keep_id
  FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
