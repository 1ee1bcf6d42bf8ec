"""Near-duplicate detection: MinHash with tensored banding, candidates confirmed on full shingle sets.

Each document gets two small collections of ``SIDE`` hashes (a hash joins ``ROWS`` minima); every pair of
a hash of the one and a hash of the other is a table key.  So ``SIDE ** 2`` tables of ``2 * ROWS`` minima
a key cost ``2 * SIDE * ROWS`` minima.  At similarity 0.8 a pair shares a key with probability
``(1 - (1 - 0.8 ** ROWS) ** SIDE) ** 2`` = 0.9994, at 0.85 with 0.99993.

Documents with equal shingle sets form a class first; only one representative of a class goes on, so
copies are never expanded.  In a bucket of representatives the smallest one is the centre, and each
member is compared with it if their sizes allow a link and ``AGREE`` of their ``2 * SIDE`` hashes agree
(probability 0.9998 at similarity 0.8).  These are confirmed on their full sets, which gives components of
links.  Members of a bucket may also be linked with each other and not with its centre, whether or not
they were compared with it: all members of a bucket are of one cluster, and in a cluster with several
components all members outside its largest component are compared with all members of other components,
exactly and in blocks of ``CHUNK`` by ``CHUNK`` documents.  A block returns links that join components
only, so no block gives all pairs.

Defined results: a null or empty text has no shingles and is linked with nothing; a text of fewer words
than a shingle is one shingle; rows repeated with one doc_id are one document: they get the same
answer, and ``kept_documents`` returns one of them; a null doc_id
counts as larger than any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.exact_dedup import one_row_each
from plinth.llm.graph import answer, components, written
from plinth.llm.text import FILTER_BYTES, Texts, chunks, field, mix, releasing, small_side, sums, windows

SHINGLE = 5
PERCENT = 80
SIDE = 8
ROWS = 2
AGREE = 4
CHUNK = 1024

_seeds = np.random.default_rng(7).integers(0, 2**63, (2, 2 * SIDE * ROWS), dtype=np.uint64)
_ODD, _SALT = _seeds[0] * np.uint64(2) + np.uint64(1), _seeds[1]

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, hashes array<long>"


def _sets(col: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, and where each text's begin."""
    t = Texts(col, lower=True)
    win, at = windows(t.hashes(), t.first, shingle, whole=True)
    for a, b in zip(at[:-1], at[1:]):
        win[a:b].sort()
    new = np.ones(win.size, bool)
    new[1:] = win[1:] != win[:-1]
    new[at[:-1][at[:-1] < win.size]] = True
    return win[new], np.concatenate([[0], np.cumsum(new)])[at]


def _lists(values: np.ndarray, width: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, width, dtype=np.int32)), pa.array(values.ravel()))


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Set size, set digest and the ``2 * SIDE`` hashes of each document (null without shingles)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=FILTER_BYTES):
            win, at = _sets(field(batch, "text"), shingle)
            n = np.diff(at)
            some = np.flatnonzero(n)
            hashes = np.zeros((n.size, 2 * SIDE), np.uint64)
            for j in range(2 * SIDE * ROWS):
                if some.size:
                    least = np.minimum.reduceat((win ^ _SALT[j]) * _ODD[j], at[some])
                    hashes[some, j // ROWS] = mix(hashes[some, j // ROWS] * np.uint64(31) + least)
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), pa.array(n), pa.array(sums(mix(win), at).view(np.int64)),
                 pa.array(sums(mix(win ^ _SALT[0]), at).view(np.int64)), _lists(hashes.view(np.int64), 2 * SIDE)],
                ["doc_id", "n_shingles", "set_a", "set_b", "hashes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(rows), SIGNATURE)


def table_keys(reps: DataFrame) -> DataFrame:
    """(key, rep): one row per table, its key joined from one hash of each collection."""
    left, right = F.slice("hashes", 1, SIDE), F.slice("hashes", SIDE + 1, SIDE)
    pair = lambda a, i: F.transform(right, lambda b, j: F.xxhash64(a, b, i * SIDE + j))
    return reps.select(F.explode(F.flatten(F.transform(left, pair))).alias("key"), "rep")


def agreeing(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose set sizes allow the similarity and whose hashes agree often enough."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("hashes").alias(f"h_{x}"))
    same = F.size(F.filter(F.zip_with("h_a", "h_b", lambda x, y: x == y), lambda z: z))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).where(same >= AGREE).select("a", "b"))


def shingle_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles): the sorted distinct shingle hashes of the named documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=FILTER_BYTES):
            win, at = _sets(field(batch, "text"), shingle)
            sets = [win[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    named = small_side(ids.select(F.col("id").alias("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(named, "doc_id", "left_semi")
    return texts.mapInArrow(releasing(rows), "doc_id long, shingles binary").dropDuplicates(["doc_id"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(field(batch, "s_a"), field(batch, "s_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if x.size > y.size:
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), max(y.size - 1, 0))
                both = int((y[at] == x).sum()) if y.size else 0
                keep.append(100 * both >= percent * (x.size + y.size - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(releasing(rows), "a long, b long")


def block_links(clusters: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of one cluster, by comparing blocks of documents exactly."""
    member = (clusters.select("node", F.col("component").alias("cluster")).join(found, "node", "left")
              .select("node", "cluster", F.coalesce("component", "node").alias("component")))
    parts = member.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    # a cluster of two documents in two components has been compared
    mixed = (parts.groupBy("cluster").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts"),
                                          F.max(F.struct("n", "component")).alias("main"))
             .where("parts > 1 and all > 2")
             .select("cluster", F.col("main.component").alias("main"), F.ceil(F.col("main.n") / CHUNK).alias("mains"),
                     F.ceil((F.col("all") - F.col("main.n")) / CHUNK).alias("others")))
    rows = member.join(mixed, "cluster")
    own = F.col("component") == F.col("main")
    chunk = F.pmod(F.xxhash64("node"), F.when(own, F.col("mains")).otherwise(F.col("others"))).alias("chunk")
    block = lambda left, kind, right, role: F.struct(left.alias("left"), F.lit(kind).alias("kind"), right.alias("right"), role.alias("role"))
    each = F.sequence(F.lit(0).cast("long"), F.col("others") - 1)
    c = F.col("chunk")
    among = F.transform(each, lambda x: block(F.least(c, x), 0, F.greatest(c, x), (x < c).cast("int")))
    against = F.transform(F.sequence(F.lit(0).cast("long"), F.col("mains") - 1), lambda x: block(c, 1, x, F.lit(0)))
    mains = F.transform(each, lambda x: block(x, 1, c, F.lit(1)))
    dealt = (rows.select("node", "cluster", "component", "mains", "others", own.alias("own"), chunk)
             .join(sets, F.col("node") == F.col("doc_id"))
             .select("cluster", "node", "component", "shingles",
                     F.explode(F.when(F.col("own"), mains).otherwise(F.concat(among, against))).alias("block"))
             .select("cluster", "node", "component", "shingles", "block.*"))

    def links(group: pa.Table) -> pa.Table:
        node, part, role = (group[x].to_numpy() for x in ("node", "component", "role"))
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["shingles"].combine_chunks()]
        size = np.array([x.size for x in own])
        base = np.flatnonzero(role == 1)
        if not base.size and group["left"][0] == group["right"][0] and group["kind"][0].as_py() == 0:
            base = np.arange(node.size)  # one chunk with itself
        if not base.size:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        value = np.concatenate([own[i] for i in base])
        owner = np.repeat(base, size[base])
        order = np.argsort(value, kind="stable")
        value, owner = value[order], owner[order]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while x in root:
                x = root[x]
            return x

        out = []
        for i in np.flatnonzero(role == 0):
            lo, hi = np.searchsorted(value, own[i], "left"), np.searchsorted(value, own[i], "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=node.size)
            near = np.flatnonzero((both > 0) & (part != part[i]) & (100 * both >= percent * (size[i] + size - both)))
            for j in near.tolist():
                x, y = find(int(part[i])), find(int(part[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return dealt.groupBy("cluster", "left", "kind", "right").applyInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    spark = docs.sparkSession
    signed = written(spark, signatures(docs, shingle), "signatures")
    total = signed.count()
    some = signed.where("n_shingles > 0")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n_shingles", "hashes"))
    classes = written(spark, some.groupBy("set_a", "set_b").agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
                      .select("set_a", "set_b", "size", F.col("best.doc_id").alias("rep"), "best.n_shingles", "best.hashes"),
                      "classes")
    reps = classes.select("rep", "n_shingles", "hashes")
    keys = table_keys(reps)
    centre = keys.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("members")).where("members > 1")
    star = written(spark, keys.join(centre, "key").where("a < rep").select("a", F.col("rep").alias("b")).distinct(), "star")
    pairs = written(spark, agreeing(star, reps, percent), "pairs")
    # a member without a pair stays in its cluster: it may be linked with others of the bucket
    sets = written(spark, shingle_sets(docs, star.select(F.explode(F.array("a", "b")).alias("id")).distinct(), shingle), "sets")
    links = written(spark, confirmed(pairs, sets, percent), "links")
    found = written(spark, components(spark, links), "components")
    extra = written(spark, block_links(components(spark, star), found, sets, percent), "links")
    if not extra.isEmpty():
        found = components(spark, links.unionByName(extra))
    named = (classes.select("set_a", "set_b", "size", "rep")
             .join(found.withColumnRenamed("node", "rep"), "rep", "left")
             .select("set_a", "set_b", "size", F.coalesce("component", "rep").alias("component_id")))
    linked = answer(some.select("doc_id", "n_shingles", "set_a", "set_b"), named, ["set_a", "set_b"], "size", total)
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay (the smallest doc_id of each component), with all their columns."""
    return one_row_each(docs, near_duplicates(docs.select("doc_id", "text"), shingle, percent).where("kept"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=4)
