"""Spelling variants: the vocabulary acceptor composed with a one-edit transducer and the acceptor again.

*Counting.*  Each task counts the letter runs of its documents; equal words meet in one aggregation.

*Acceptor.*  The words of a partition become a minimised deterministic acceptor (sorted words, equal
states shared).  Each state carries the lengths of the rests it accepts, as a mask of lengths mod ``LENGTHS``.

*Transducer.*  State 0 copies code points; the arcs x:y, x:empty and empty:x lead to state 1, which copies as well and is
final.  As the acceptor is deterministic, a composed state before the edit is one acceptor state, and after it
a pair (p, q) that accepts the rests that both accept.  All accepted pairs are enumerated along the words of the first
acceptor; pairs of states that accept nothing are remembered.  Of the ways to delete one of several equal
neighbours the last one counts, so each pair is found once.

*Partitions of the initial state.*  A partition holds the words with one prefix, from the state that the acceptor
reaches by it.  The empty prefix is split by the next code point for as long as a prefix has more than ``WORDS`` words.  Pairs whose
edit is the very first arc of a split prefix lie in different partitions: their rests are equal, so they
meet in a join on (prefix, rest), whose groups hold at most one word per letter and one without; every member gets
the group's size and its best other member, and no pairs are formed.

*Result.*  A word's form is its near word of largest count if that is at least twice its own; roots
follow the forms by doubled pointers, joined and written to the shared folder until none moves.

Defined results: a null or empty text has no words; a null doc_id deletes no code point; repeated rows are counted
as often as they occur; of near words with equal counts the smallest in code-point order is the form; an empty table gives an
empty result; other columns are ignored; a word of any length is kept whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.graph import written
from plinth.llm.text import chunks, field, small_side

LEAST_LETTERS, LEAST_COUNT, TIMES = 5, 3, 2
#: One in so many (document, word) pairs loses a code point.
LOST_ONE_IN = 97
#: Words of one partition at most.
WORDS = 20_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 400_000
LENGTHS = 61
_ALL = (1 << LENGTHS) - 1

# Letters are A-Z, a-z and U+00C0 to U+00FF, in UTF-8 the lead byte C3 and any following byte.
_OTHER = re.compile(rb"[\xc2\xc4-\xdf].|[\xe0-\xef]..|[\xf0-\xf7]...", re.DOTALL)
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 0x80 <= b <= 0xBF or b == 0xC3 else 32 for b in range(256))


def letter_runs(text: bytes) -> list[bytes]:
    """The maximal letter runs of a UTF-8 text, A-Z lower-cased."""
    return _OTHER.sub(b" ", text).translate(_LETTERS).split()


def _counted(lost: int):
    """Counts of words per task, passed on when ``HELD_WORDS`` are held."""

    def emit(held: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        get, crc32 = held.get, zlib.crc32
        for batch in chunks(batches):
            for doc_id, text in zip(field(batch, "doc_id").to_pylist(), field(batch, "text").cast(pa.binary()).to_pylist()):
                if not text:
                    continue
                own = Counter(letter_runs(text))
                if doc_id is None or not lost:
                    for word, n in own.items():
                        held[word] = get(word, 0) + n
                else:
                    base = crc32(b"%d:" % doc_id)
                    for word, n in own.items():
                        h = crc32(word, base)
                        if not h % lost:
                            full = word.decode()
                            at = h % len(full)
                            word = (full[:at] + full[at + 1 :]).encode()
                        held[word] = get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield emit(held)
                    held.clear()
        yield emit(held)

    return count


def vocabulary(docs: DataFrame, lost: int = 0, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): letter runs of at least ``letters`` code points that occur ``least`` times or more in all texts.

    ``lost``: where it divides crc32 of ``<doc_id>:<word>``, the word of that document loses a code point.
    """
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_counted(lost), "word string, n long")
    return (parts.where(F.length("word") >= letters).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


class Acceptor:
    """A minimised acceptor of distinct words given in sorted order: arcs, finality and lengths of each state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.lengths: list[int] = []
        known: dict[tuple, int] = {}

        def closed(arcs: dict[str, int], final: bool) -> int:
            key = (final, *arcs.items())
            state = known.get(key)
            if state is None:
                state = known[key] = len(self.arcs)
                mask = int(final)
                for to in arcs.values():
                    m = self.lengths[to] << 1
                    mask |= (m & _ALL) | (m >> LENGTHS)
                self.arcs.append(arcs)
                self.final.append(final)
                self.lengths.append(mask)
            return state

        open_arcs: list[dict[str, int]] = [{}]  # along the last word; their last arc is not closed yet
        open_final = [False]
        last = ""
        for word in [*words, None]:
            same = 0
            if word is not None:
                most = min(len(word), len(last))
                while same < most and word[same] == last[same]:
                    same += 1
            for at in range(len(last), same, -1):
                open_arcs[at - 1][last[at - 1]] = closed(open_arcs.pop(), open_final.pop())
            if word is None:
                break
            for _ in range(same, len(word)):
                open_arcs.append({})
                open_final.append(False)
            open_final[-1] = True
            last = word
        self.start = closed(open_arcs[0], open_final[0])


class OneEdit:
    """The acceptor composed with the one-edit transducer and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.a = acceptor
        self.dead: set[tuple[int, int]] = set()

    def rests(self, p: int, q: int, but: str | None = None) -> list[str]:
        """The rests that both states accept, without those that begin with ``but``."""
        arcs, final, lengths = self.a.arcs, self.a.final, self.a.lengths
        dead, out, path, met = self.dead, [], [], []
        if not lengths[p] & lengths[q] or (p, q) in dead:
            return out
        todo = [(0, "", p, q)]
        while todo:
            depth, c, p, q = todo.pop()
            if depth:
                del path[depth - 1 :]
                path.append(c)
            met.append((p, q))
            if final[p] and final[q]:
                out.append("".join(path))
            one, two = arcs[p], arcs[q]
            if len(two) < len(one):
                one, two = two, one
            for c in one:
                if c in two and (depth or c != but):
                    to = (arcs[p][c], arcs[q][c])
                    if lengths[to[0]] & lengths[to[1]] and to not in dead:
                        todo.append((depth + 1, c, *to))
        if not out:
            dead.update(met if but is None else met[1:])
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words that differ by one edit, once; of different lengths the longer first."""
        arcs, lengths = self.a.arcs, self.a.lengths
        path: list[str] = []
        todo = [(0, "", self.a.start)]
        while todo:
            depth, c, state = todo.pop()
            if depth:
                del path[depth - 1 :]
                path.append(c)
            own = list(arcs[state].items())
            prefix = None
            for k, (x, to) in enumerate(own):
                for rest in self.rests(to, state, x):
                    prefix = "".join(path) if prefix is None else prefix
                    yield f"{prefix}{x}{rest}", prefix + rest
                for y, other in own[:k]:
                    if lengths[to] & lengths[other]:
                        for rest in self.rests(to, other):
                            prefix = "".join(path) if prefix is None else prefix
                            yield f"{prefix}{x}{rest}", f"{prefix}{y}{rest}"
            todo.extend((depth + 1, x, to) for x, to in own)


NEAR = "word string, n_near long, near_n long, near string"


def _near_words(part: pa.Table) -> pa.Table:
    """Per word of one partition with a near word there: their number and the best of them."""
    count = dict(zip(part.column("word").to_pylist(), part.column("n").to_pylist()))
    words = sorted(count)
    number = dict.fromkeys(words, 0)
    best: dict[str, tuple[int, str]] = {}
    for pair in OneEdit(Acceptor(words)).pairs():
        for word, other in (pair, pair[::-1]):
            number[word] += 1
            n = count[other]
            was = best.get(word)
            if was is None or n > was[0] or n == was[0] and other < was[1]:
                best[word] = (n, other)
    return pa.table({"word": pa.array(list(best), pa.string()), "n_near": pa.array([number[w] for w in best], pa.int64()),
                     "near_n": pa.array([x[0] for x in best.values()], pa.int64()), "near": pa.array([x[1] for x in best.values()], pa.string())})


def _first_arc(words: DataFrame, depth: int) -> DataFrame:
    """Near words of one prefix of ``depth`` code points whose edit is the arc after it: (word, n_near, near_n, near).

    Rows meet by prefix and rest.  ``x`` is the edited code point, null in the word that lacks it; a word whose
    rest begins with ``x`` is no partner of that one, as deleting the next ``x`` gives the same word.
    """
    prefix = F.substring("word", 1, depth)
    x, rest = F.expr(f"substring(word, {depth + 1}, 1)"), F.expr(f"substring(word, {depth + 2})")
    whole = F.expr(f"substring(word, {depth + 1})")
    own = F.array(F.struct(x.alias("x"), rest.alias("rest")), F.struct(F.lit(None).cast("string").alias("x"), whole.alias("rest")))
    rows = words.select("word", "n", prefix.alias("prefix"), F.explode(F.when(F.length("word") > depth, own).otherwise(F.slice(own, 2, 1))).alias("e"))
    rows = rows.select("word", "n", "prefix", "e.x", "e.rest")
    first = F.coalesce(F.col("x") == F.substring("rest", 1, 1), F.lit(False))
    member = F.struct((-F.col("n")).alias("m"), "word", "x", first.alias("first"))
    groups = rows.groupBy("prefix", "rest").agg(F.array_sort(F.collect_list(member)).alias("all")).where(F.size("all") > 1)
    # at most one member a letter and one without: each takes the others that it is near to, best first
    mine = groups.select(F.explode("all").alias("m"), "all")
    near = F.filter("all", lambda o: (o["word"] != F.col("m.word")) & ~((o["x"].isNull() & F.col("m.first")) | (F.col("m.x").isNull() & o["first"])))
    mine = mine.select(F.col("m.word").alias("word"), near.alias("near"))
    best = F.element_at("near", 1)
    return mine.where(F.size("near") > 0).select("word", F.size("near").cast("long").alias("n_near"), (-best["m"]).alias("near_n"), best["word"].alias("near"))


def near_words(spark: SparkSession, words: DataFrame, most: int = WORDS) -> DataFrame:
    """(word, n_near, near_n, near) for every word of (word, n) with a near word; near is the most frequent one."""
    found, left, depth = [], words, 0
    whole = words.count() <= most
    while not whole:
        found.append(_first_arc(left, depth))
        depth += 1
        left = left.where(F.length("word") >= depth)
        prefix = F.substring("word", 1, depth)
        groups = written(spark, left.groupBy(prefix.alias("prefix")).count(), "prefixes")
        large = small_side(groups.where(F.col("count") > most).select("prefix"))
        found.append(left.withColumn("prefix", prefix).join(large, "prefix", "left_anti").groupBy("prefix").applyInArrow(_near_words, NEAR))
        left = left.withColumn("prefix", prefix).join(large, "prefix", "left_semi").drop("prefix")
        whole = groups.where(F.col("count") > most).isEmpty()
    if not found:
        found = [words.groupBy(F.lit("").alias("prefix")).applyInArrow(_near_words, NEAR)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b")
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.m")).alias("near_n"), F.col("b.near").alias("near"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) for every row of (word, form): the last word on the way of forms.  Counts double along it, so
    it ends, and the rounds grow with the logarithm of its length."""
    at = written(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(spark, at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(docs: DataFrame, lost: int = 0, most: int = WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary of (doc_id, text)."""
    spark = docs.sparkSession
    words = written(spark, vocabulary(docs, lost), "vocabulary")
    near = written(spark, words.join(near_words(spark, words, most), "word", "left").withColumn("is", F.col("near_n") >= TIMES * F.col("n")), "near")
    last = roots(spark, near.where("is").select("word", F.col("near").alias("form")))
    return near.join(last, "word", "left").select("word", F.expr("if(is, near, null)").alias("form"), F.coalesce("root", "word").alias("root"), "n",
                                                  F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("if(is, near_n, null)").alias("form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"), LOST_ONE_IN)
