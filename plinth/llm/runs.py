"""Periodic runs of words: suffix automaton, link-cut access, squares extended to runs.

A run is a stretch of words with smallest period q (words q apart are equal) and at least
``max(LEAST, TIMES * q)`` words that no neighbouring word extends.  Two steps find them:

* *Stretches.*  A necessary condition on every word of a run, by NumPy over a whole chunk of texts: for
  q up to ``NEAR`` words q apart are compared directly; a run of a larger period is a stretch in which
  every window of ``NEAR`` words occurs three times or more in its text.  No run crosses the edge of a stretch, so the
  rest of the text needs no automaton.  Unequal windows that share a hash only make a stretch longer.
* *Automaton.*  The suffix automaton of each stretch is built word by word.  Its link tree is cut into heavy
  paths, and the appended words are replayed: appending word i accesses the path from the state of the prefix to
  the root and recolours it to i.  Each path holds its colours (the last occurrences) as a stack of segments, so an access
  meets each old segment once: its colour e and its deepest state of length L say that the longest suffix
  last seen at e has L words.  With d = i - e <= L that is a square of period d, with L >= (TIMES - 1) * d a part of a
  run, which starts at i - d - L + 1; the last i that names this start and period is the run's end.

An access costs O(log n) segments, amortised.  Memory is linear in one stretch of one document (some
0.7 kB a word); a text without periodic words costs arrays of a chunk only.

Defined results: a null, empty or blank text has no words and no runs and collapses to the empty text; repeated
rows, null ids and equal texts are treated alike, each row by itself; ties cannot arise, as a run is
named by start and period; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.text import chunks, field, mix

LEAST = 6
TIMES = 4
#: Periods up to this are compared directly; longer ones must repeat windows of so many words.
NEAR = 8
SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
WORD = r"[\x20\x09-\x0D]+"

_LANES = mix(np.arange(1, NEAR + 1, dtype=np.uint64)) | np.uint64(1)


def suffix_links(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length, link, state of each prefix) of the words' suffix automaton; state 0 is the root."""
    length, link, to = [0], [-1], [{}]
    prefix, last = [], 0
    for i, w in enumerate(words):
        new = len(length)
        length.append(i + 1)
        link.append(0)
        to.append({})
        p = last
        while p >= 0 and w not in to[p]:
            to[p][w] = new
            p = link[p]
        if p >= 0:
            q = to[p][w]
            if length[q] != length[p] + 1:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                to.append(to[q].copy())
                link[q] = clone
                while p >= 0 and to[p].get(w) == q:
                    to[p][w] = clone
                    p = link[p]
                q = clone
            link[new] = q
        prefix.append(new)
        last = new
    return length, link, prefix


def heavy_paths(length: list[int], link: list[int]) -> list[int]:
    """The top state of each state's heavy path in the link tree."""
    n = len(length)
    order = sorted(range(1, n), key=length.__getitem__)
    size, heavy = [1] * n, [0] * n
    for s in reversed(order):
        up = link[s]
        size[up] += size[s]
        if not heavy[up] or size[s] > size[heavy[up]]:
            heavy[up] = s
    top = list(range(n))
    for s in order:
        if heavy[link[s]] == s:
            top[s] = top[link[s]]
    return top


def squares(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(i, d, L) for every word i and segment of its access with L >= (TIMES - 1) * d: the longest suffix that
    ends at i and was last seen d words before has L words."""
    length, link, prefix = suffix_links(words)
    top = heavy_paths(length, link)
    stacks: dict[int, list[tuple[int, int]]] = {}  # a path's segments (deepest length, colour), the deepest first
    for i, state in enumerate(prefix):
        seen = -1
        while state > 0:
            path = top[state]
            deep = length[state]
            held = stacks.setdefault(path, [])
            old: list[tuple[int, int]] = []
            while held and held[-1][0] <= deep:
                old.append(held.pop())
            if held and (not old or old[-1][0] < deep):
                old.append((deep, held[-1][1]))
            held.append((deep, i))
            for most, e in reversed(old):
                if e != seen:
                    seen = e
                    if most >= (TIMES - 1) * (i - e):
                        yield i, i - e, most
            state = link[path]


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    last = {(i - d - most + 1, d): i for i, d, most in squares(words)}
    found = [(s, i - s + 1, d) for (s, d), i in last.items()]
    return sorted(x for x in found if x[1] >= max(LEAST, TIMES * x[2]))


def _stretched(flag: np.ndarray, least: int, mark: np.ndarray, more: int) -> None:
    """Marks positions of the stretches of ``least`` or more set flags, and ``more`` positions after each."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
    lo, hi = edge[::2], edge[1::2]
    long = hi - lo >= least
    np.add.at(mark, lo[long], 1)
    np.add.at(mark, hi[long] + more, -1)


def candidate_words(ids: np.ndarray) -> np.ndarray:
    """Flags of the words that may lie in a run; ``ids`` holds the texts of a chunk, a unique id between two texts."""
    n = ids.size
    mark = np.zeros(n + 1, np.int32)
    for q in range(1, min(NEAR, n - 1) + 1):
        _stretched(ids[q:] == ids[:-q], max(LEAST, TIMES * q) - q, mark, q)
    far = NEAR + 1
    if n >= TIMES * far:
        h = np.zeros(n - NEAR + 1, np.uint64)
        for j in range(NEAR):
            h += ids[j : n - NEAR + 1 + j].astype(np.uint64) * _LANES[j]
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.diff(np.concatenate([h[order[:1]] + np.uint64(1), h[order]])))
        often = np.repeat(np.diff(np.append(first, h.size)) >= TIMES - 1, np.diff(np.append(first, h.size)))
        live = np.zeros(h.size, bool)
        live[order] = often
        _stretched(live, TIMES * far - NEAR + 1, mark, NEAR - 1)
    return np.cumsum(mark[:-1]) > 0


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words."""
    n = [len(t) for t in texts]
    code: dict[bytes, int] = {}
    ids = np.full(sum(n) + len(n), -1, np.int64)
    at, starts = 0, []
    for t in texts:
        code.update(zip(dict.fromkeys(w for w in t if w not in code), range(len(code), len(code) + len(t))))
        ids[at : at + len(t)] = np.fromiter(map(code.__getitem__, t), np.int64, len(t))
        starts.append(at)
        at += len(t) + 1
    gaps = np.array(starts, np.int64) + np.array(n, np.int64)
    ids[gaps] = -1 - np.arange(len(n))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], candidate_words(ids).view(np.int8), [0]])))
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
        for start, length, period in runs_of(ids[lo:hi].tolist()):
            text = int(np.searchsorted(gaps, lo + start))
            out[text].append((lo + start - starts[text], length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(w for w, covered in zip(words, np.cumsum(edge[:-1]).tolist()) if not covered)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in chunks(batches):
        texts = [x.split() if x else [] for x in field(batch, "text").cast(pa.binary()).to_pylist()]
        runs = runs_of_texts(texts)
        kept = pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())
        rows = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
        yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(rows, kind), kept], ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs by start and period, collapsed text) of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_found, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where crc32 of the decimal doc_id is divisible by 10, the words from a on repeat with period p.

    With g = floor(crc32 / 10) and n words: a = g % n, p = 1 + floor((n - a) / (3 + g % 8)); a null doc_id or a text
    without words stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), WORD), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(h % 10 == 0, words).alias("w"),
                       F.floor(h / 10).alias("g"))
    n = F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", F.col("a") * 0 + 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.concat(F.slice("w", 1, F.col("a").cast("int")),
                     F.transform(F.sequence(F.lit(0).cast("long"), n - 1 - F.col("a")),
                                 lambda k: F.get("w", (F.col("a") + k % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    key = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                  r["period"].cast("string"), )), "\n")
    found = found.withColumn("top", F.array_max(key)).withColumn("lines", F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
                        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
                        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
                        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
