"""Three-gram language model in Elias-Fano tries, sharded by context.

The model interpolates absolute-discounted three-grams, two-grams and words; what the word discounts save
is the probability of the unknown word.  Training counts come from the documents outside the held-out
fold, over their whole texts; every document is scored.

All data moves in blocks of about ``BLOCK_TOKENS`` tokens and in as many shards as the tokens need at
``SHARD_TOKENS`` each, so memory does not depend on the input as long as no pair of words (u, v) has more
than a shard's tokens after it (they go to one shard; the start of a text is split).  A task has up to
``GROUP_SHARDS`` shards one after the other, so a block sends that many times fewer, larger messages:

1. A block lists its distinct words and counts them.  Word counts are summed by hash part (a word costs
   a row a block, however frequent) and every block gets back its words' counts and compact ids, in a file
   for the blocks of one task.
2. Each block sends every token with its two predecessors to the shard of the middle word: the shard
   has all there is about that word as a context.  A context word with more than half a shard's tokens
   is split by the word before it, within one group of shards if that holds all its parts.  The two-grams of
   words with parts in several groups are added up before, in a folder by context word.  The start of a text,
   which has no such word, is split by document: its two-grams are its three-grams.
3. A group adds up the two-grams of the words split within it.  A shard then counts, builds the trie of its contexts in
   a file of the shared folder, maps it into memory and looks its distinct three-grams up; a group returns the
   sum of log probabilities per document and block.

Trie levels: context words; their successors (two-grams, with the smoothed probability); the words before
them (with the weight of the back-off); three-grams, whose word is stored as its place among the
two-gram's successors.  Probabilities are quantised to 8 bits.

Defined results: a null or empty text is the one end token; without training documents every word is
unknown with probability 1; repeated rows are scored alike (a null doc_id counts as training); an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.elias_fano import EliasFano, Level, from_buffer, quantised, runs, to_bytes
from plinth.llm.graph import WIDE_ROWS, written
from plinth.llm.text import Texts, chunks, field, mix, releasing, releasing_group
from plinth.llm.warc import file_system
from plinth.session import scratch_path

FOLDS = 10
BLOCK_TOKENS = 1_500_000
SHARD_TOKENS = 1_000_000
#: A task has several shards, up to so many, where there are more than ``GROUPS`` groups of them.
GROUP_SHARDS, GROUPS = 4, 64
#: So many shards' tokens are counted by one word part.
PART_SHARDS = 8
#: Rows of two-grams of words with parts in several groups that one task adds up.
WIDE_PAIRS = 2_000_000
DISCOUNT_2, DISCOUNT_3 = 0.75, 0.9
_END = np.uint64(0x5DEECE66D1CE4E5B)
#: Ids of what stands before a text and of words without training count; other words have larger ones.
_START, _UNKNOWN, _FIRST = 0, 1, 2
_PARTS = 24  # bits of a context key for the part of a split context, from 1; 0: it is not split
_WIDE = 1 << 23  # added to the part if the context has parts in several groups
_STEP = 4096.0  # of a word's log10 probability on its way to the shards, and of a sum on its way back from several groups

RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _squeeze(*columns: np.ndarray) -> bytes:
    """Integer columns, byte plane by byte plane, compressed."""
    out = []
    for c in columns:
        width = max(1, (int(c.max(initial=0)).bit_length() + 7) // 8)
        planes = c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        small = pa.compress(planes, codec="zstd", asbytes=True)
        out += [np.array([c.size, width, len(small)], np.int64).tobytes(), small]
    return b"".join(out)


def _unsqueeze(data: bytes, only: tuple[int, ...] | None = None, part: slice = slice(None)) -> list[np.ndarray]:
    """The columns, or ``part`` of those in ``only``."""
    out, at, k = [], 0, 0
    while at < len(data):
        n, width, size = np.frombuffer(data, np.int64, 3, at).tolist()
        at += 24
        if only is None or k in only:
            planes = np.frombuffer(pa.decompress(data[at : at + size], n * width, codec="zstd"), np.uint8).reshape(width, n)[:, part]
            full = np.zeros((planes.shape[1], 8), np.uint8)
            full[:, :width] = planes.T
            out.append(full.view("<i8").ravel())
        at += size
        k += 1
    return out


def _squeeze_sorted(hashes: np.ndarray) -> bytes:
    """Ascending 64-bit hashes by their distances, whose upper bytes are mostly 0."""
    return _squeeze(np.diff(hashes, prepend=np.uint64(0)))


def _unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unsqueeze(data)[0].view(np.uint64), dtype=np.uint64)


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _bytes(column: pa.ChunkedArray) -> list[memoryview]:
    """The values of a binary column without copying."""
    out = []
    for chunk in column.chunks:
        if not len(chunk):
            continue
        _, offsets, data = chunk.buffers()
        kind = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
        off = np.frombuffer(offsets, kind)[chunk.offset : chunk.offset + len(chunk) + 1].tolist()
        view = memoryview(data if data is not None else b"")
        out += [view[a:b] for a, b in zip(off, off[1:])]
    return out


def _starts(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal neighbours begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(values.size, 1), bool), values[1:] != values[:-1]]))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in ascending order, how often)."""
    values = np.sort(values)
    at = _starts(values)
    return values[at], np.diff(at, append=values.size)


def _placed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in ascending order, the place of each value among them)."""
    bits = values.size.bit_length()
    if int(values.max(initial=0)).bit_length() + bits > 63:
        return np.unique(values, return_inverse=True)
    # a sort of values with their places in the lower bits is faster than a sort of places
    packed = np.sort(values << bits | np.arange(values.size))
    at, packed = packed & ((1 << bits) - 1), packed >> bits
    new = np.ones(packed.size, bool)
    np.not_equal(packed[1:], packed[:-1], out=new[1:])
    place = np.empty(packed.size, np.int64)
    place[at] = np.cumsum(new) - 1
    return packed[new], place


def _placed_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_placed`` for 64-bit hashes: sorted by their upper bits, which tell them apart, or in full."""
    bits = np.uint64(hashes.size.bit_length())
    packed = np.sort(hashes >> bits << bits | np.arange(hashes.size, dtype=np.uint64))
    at = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    upper, full = packed >> bits, hashes[at]
    new = np.ones(full.size, bool)
    np.not_equal(full[1:], full[:-1], out=new[1:])
    if (new[1:] & (upper[1:] == upper[:-1])).any():
        return np.unique(hashes, return_inverse=True)
    place = np.empty(full.size, np.int64)
    place[at] = np.cumsum(new) - 1
    return full[new], place


# 1. blocks and word counts


def blocks(docs: DataFrame) -> DataFrame:
    """One row a block: its documents, and their tokens as places in the block's list of distinct words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, 0
        words: list[np.ndarray] = []
        ids: list[int | None] = []
        sizes: list[np.ndarray] = []
        train: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            number += 1
            size, learn = np.concatenate(sizes), np.concatenate(train)
            vocabulary, token = _placed_hashes(np.concatenate(words))
            own = np.bincount(token, weights=np.repeat(learn, size), minlength=vocabulary.size).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([task | number]), pa.array([ids], pa.list_(pa.int64())), pa.array([int(size.sum())]),
                 pa.array([int(learn.sum())]), _binary([_squeeze_sorted(vocabulary)]), _binary([_squeeze(own)]),
                 _binary([_squeeze(size, learn.astype(np.int64), token)])],
                ["block", "doc_ids", "tokens", "train_docs", "words", "counts", "body"])

        for batch in chunks(batches):
            t = Texts(field(batch, "text"), lower=True)
            h = t.hashes()
            words.append(np.insert(h, t.first[1:], _END))
            sizes.append(t.words + 1)
            ids += field(batch, "doc_id").to_pylist()
            train.append(field(batch, "train").to_numpy(zero_copy_only=False).astype(bool))
            if sum(w.size for w in words) >= BLOCK_TOKENS:
                yield block()
                words, ids, sizes, train = [], [], [], []
        if words:
            yield block()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~held_out()).alias("train"))
    return source.mapInArrow(rows, "block long, doc_ids array<long>, tokens long, train_docs long, words binary, counts binary, body binary")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def word_part(words: np.ndarray, parts: int) -> np.ndarray:
    """The word part of each hash: ranges of hashes, so that a block's sorted words are in part order."""
    return ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def word_counts(table: DataFrame, parts: int) -> DataFrame:
    """For each block and word part: ids and training counts of the block's words, in the block's order.

    The rows of block -1 hold each part's statistics: words, tokens, words seen once and twice; the highest count.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = _unsqueeze_sorted(field(batch, "words")[i].as_py())
                (own,) = _unsqueeze(field(batch, "counts")[i].as_py())
                cut = np.searchsorted(word_part(words, parts), np.arange(parts + 1))
                used = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), pa.array([field(batch, "block")[i].as_py()] * used.size, pa.int64()),
                     _binary([_squeeze_sorted(words[cut[p] : cut[p + 1]]) for p in used]),
                     _binary([_squeeze(own[cut[p] : cut[p + 1]]) for p in used])], ["part", "block", "words", "counts"])

    def add(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        words = [_unsqueeze_sorted(x) for x in group["words"].to_pylist()]
        own = [_unsqueeze(x)[0] for x in group["counts"].to_pylist()]
        word, place = _placed_hashes(np.concatenate(words))
        count = np.bincount(place, weights=np.concatenate(own)).astype(np.int64)
        rank = np.empty(word.size, np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(word.size)
        ids = np.where(count > 0, _FIRST + rank * parts + part, _UNKNOWN)
        ends = np.cumsum([w.size for w in words])
        back = [_squeeze(ids[place[b - w.size : b]], count[place[b - w.size : b]]) for w, b in zip(words, ends)]
        seen = count[count > 0]
        back.append(_squeeze(np.array([seen.size, seen.sum(), (seen == 1).sum(), (seen == 2).sum()]), seen.max(initial=0, keepdims=True)))
        return pa.table({"block": pa.array([*group["block"].to_pylist(), -1], pa.int64()),
                         "part": pa.array([part] * len(back), pa.int32()), "counts": _binary(back)})

    asked = table.select("block", "words", "counts").mapInArrow(ask, "part int, block long, words binary, counts binary")
    return asked.groupBy("part").applyInArrow(add, "block long, part int, counts binary")


def group_size(shards: int) -> int:
    """How many shards a task has."""
    return min(GROUP_SHARDS, max(1, shards // GROUPS))


def paged(spark: SparkSession, counted: DataFrame) -> str:
    """The folder of ``word_counts``, in a folder ``page=`` for the blocks of one task (-1: the statistics)."""
    path = scratch_path(spark, "lm-words")
    counted.withColumn("page", F.expr("shiftright(block, 32)")).repartition("page").write.options(**WIDE_ROWS).partitionBy("page").parquet(path)
    return path


class Unigrams:
    """Word probabilities from the corpus's count statistics (absolute discounting; the rest is the unknown word's)."""

    def __init__(self, words: int, tokens: int, once: int, twice: int, train_docs: int, shards: int):
        self.words, self.tokens, self.train_docs = words, tokens, train_docs
        self.group = group_size(shards)
        self.shards = -(-shards // self.group) * self.group
        self.discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)

    def probability(self, count: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(count.size)
        return np.where(count > 0, count - self.discount, self.discount * self.words) / self.tokens

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.words + 1)))

    def parts(self, count: np.ndarray) -> np.ndarray:
        """Into how many parts a context word with this count is split."""
        if self.shards == 1:
            return np.ones_like(count)
        return np.maximum(1, -(-count * 2 * self.shards // max(self.tokens, 1)))

    def homes(self, names: np.ndarray, split: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The shards of parts of context words: one after the other, within one group if all parts fit in."""
        base = (mix((names << _PARTS).astype(np.uint64)) % np.uint64(self.shards)).astype(np.int64)
        near = base // self.group * self.group + (base + part) % self.group
        return np.where(split <= self.group, near, (base + part) % self.shards)


# 2. requests


class Block:
    """A block's tokens as places among its words by id; place 0 is the start of a text, unknown words have one id."""

    def __init__(self, body: bytes, answers: list[tuple[int, bytes]], words: Unigrams):
        self.size, self.train, token = _unsqueeze(body)
        # a block's words are sorted by hash, and so are its answers, part by part
        number, seen = (np.concatenate(x) for x in zip(*(_unsqueeze(x) for _, x in sorted(answers))))
        known, place = _placed(number)
        self.names, self.count = np.append(_START, known), np.zeros(known.size + 1, np.int64)
        self.count[place + 1] = seen
        before = self.count.copy()
        before[0] = words.train_docs
        self.split = words.parts(before)
        self.token = (place + 1)[token]
        self.doc = np.repeat(np.arange(self.size.size), self.size)
        self.first = np.cumsum(self.size) - self.size
        self.v = np.empty_like(self.token)
        self.v[1:] = self.token[:-1]
        self.v[self.first] = 0


def _blocks_with_words(table: DataFrame, folder: str, words: Unigrams, use, schema: str) -> DataFrame:
    """The rows that ``use`` makes of each block (its number and the ``Block``); ``folder``: see ``paged``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        page, answers = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                number = field(batch, "block")[i].as_py()
                if number >> 32 != page:
                    page, answers = number >> 32, {}
                    got = pq.read_table(f"{path}/page={page}", columns=["block", "part", "counts"], filesystem=store, partitioning=None)
                    for block, part, counts in zip(*(got[c].to_pylist() for c in ("block", "part", "counts"))):
                        answers.setdefault(block, []).append((part, counts))
                    del got
                yield use(number, Block(field(batch, "body")[i].as_py(), answers.pop(number), words))

    return table.select("block", "body").mapInArrow(releasing(rows), schema)


def wide_pairs(table: DataFrame, folder: str, words: Unigrams) -> str:
    """The folder of all two-grams of words with parts in several groups, in a folder ``v=`` for each such word."""
    tasks = max(1, words.tokens // WIDE_PAIRS)

    def count(number: int, b: Block) -> pa.RecordBatch:
        at = np.flatnonzero((b.split > words.group)[b.v] & (b.train > 0)[b.doc])
        low = int(b.names.size).bit_length()
        pair, n = _counted(b.v[at] << low | b.token[at])
        v, w = pair >> low, b.names[pair & ((1 << low) - 1)]
        # a word's two-grams go to few tasks
        spread = np.maximum(1, -(-(np.where(v == 0, words.train_docs, b.count[v])) // WIDE_PAIRS)).astype(np.uint64)
        v = b.names[v]
        task = ((mix(v.astype(np.uint64)) + mix(w.astype(np.uint64)) % spread) % np.uint64(tasks)).astype(np.int64)
        order = np.argsort(task, kind="stable")
        used = _starts(task[order])
        rows = [_squeeze(v[o], w[o], n[o]) for o in np.split(order, used[1:])] if order.size else []
        return pa.RecordBatch.from_arrays([pa.array(task[order][used], pa.int64()), _binary(rows)], ["task", "body"])

    def add(group: pa.Table) -> pa.Table:
        v, w, n = (np.concatenate(x) for x in zip(*(_unsqueeze(x) for x in _bytes(group["body"]))))
        size = int(w.max()) + 1
        pair, place = _placed(v * size + w)
        n = np.bincount(place, weights=n).astype(np.int64)
        at = _starts(pair // size)
        rows = [_squeeze(np.diff(x % size, prepend=0), y) for x, y in zip(np.split(pair, at[1:]), np.split(n, at[1:]))]
        return pa.table({"v": pa.array(pair[at] // size, pa.int64()), "body": _binary(rows)})

    path = scratch_path(table.sparkSession, "lm-pairs")
    asked = _blocks_with_words(table, folder, words, count, "task long, body binary")
    got = asked.groupBy("task").applyInArrow(releasing_group(add), "v long, body binary")
    got.repartition("v").write.options(**WIDE_ROWS).partitionBy("v").parquet(path)
    return path


def requests(table: DataFrame, counted: DataFrame | str, words: Unigrams) -> DataFrame:
    """(shard, block, kind, body): tokens with their contexts for the groups of shards, and one row of plain sums a block.

    ``counted``: the rows of ``word_counts``, or the folder where ``paged`` wrote them.  ``shard``: the group.
    """
    group, groups = words.group, words.shards // words.group

    def route(number: int, b: Block) -> pa.RecordBatch:
        size, train, names, count, split, token, doc, v = b.size, b.train, b.names, b.count, b.split, b.token, b.doc, b.v
        u = np.empty_like(token)
        u[2:] = token[:-2]
        u[b.first] = 0
        u[b.first[size > 1] + 1] = 0
        chance = words.probability(count)
        alone = names[v] == _UNKNOWN
        sums = [np.bincount(doc, weights=x, minlength=size.size) for x in
                ((count > 0)[token], words.base(count)[token], np.where(alone, np.log10(chance)[token], 0.0))]
        text = np.concatenate([size.astype(float), *sums, train.astype(float)]).tobytes()
        code = np.minimum(np.round(-np.log10(chance) * _STEP), 65535).astype(np.int64)
        # the parts of contexts, which are in the order of their keys, and their places by shard and key
        begin = np.cumsum(split) - split
        of = np.repeat(np.arange(split.size), split)
        part = np.arange(of.size) - begin[of]
        part_key = names[of] << _PARTS | np.where(split[of] > 1, part + 1, 0) | np.where(split[of] > group, _WIDE, 0)
        home = words.homes(names[of], split[of], part)
        by_home = np.argsort(home, kind="stable")
        rank = np.empty_like(by_home)
        rank[by_home] = np.arange(by_home.size)
        # all first words have one (u, v): they are dealt by document
        cell = begin[v]
        many = np.flatnonzero((split > 1)[v])
        dealt = np.where(v[many] == 0, doc[many], names[u[many]]).astype(np.uint64)
        cell[many] += (mix(dealt) % split[v[many]].astype(np.uint64)).astype(np.int64)
        asked = np.flatnonzero(~alone)
        bits = token.size.bit_length()
        packed = np.sort(rank[cell[asked]] << bits | asked)
        order, key = packed & ((1 << bits) - 1), part_key[by_home[packed >> bits]]
        cut = np.searchsorted(packed, np.searchsorted(home[by_home], np.arange(words.shards + 1)) << bits)
        del packed, cell, asked
        step = np.diff(key, prepend=0)
        whole = cut[:-1][np.diff(cut) > 0]
        step[whole] = key[whole]
        own = (doc * 2 + train[doc])[order]
        u, w = names[u[order]], token[order]
        out = [(number % groups, 1, text)]
        for s in range(groups):
            at = cut[s * group : (s + 1) * group + 1]
            if at[0] < at[-1]:
                o = slice(at[0], at[-1])
                out.append((s, 0, _squeeze(step[o], u[o], names[w[o]], code[_counted(w[o])[0]], own[o], np.diff(at))))
        shard, kind, body = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array([number] * len(out), pa.int64()), pa.array(kind, pa.int32()),
                                           _binary(body)], ["shard", "block", "kind", "body"])

    folder = counted if isinstance(counted, str) else paged(table.sparkSession, counted)
    return _blocks_with_words(table, folder, words, route, "shard int, block long, kind int, body binary")


# 3. tries


class Messages:
    """The messages of blocks to one group of shards, kept compressed."""

    def __init__(self, bodies: list[memoryview], shards: int, wide: str | None):
        self.bodies, self.wide = bodies, wide
        self.cuts: list[list[int]] = []
        #: The documents of each message; they are numbered from one message to the next.
        self.docs: list[np.ndarray] = []
        #: All words of the group and the codes of their probabilities.
        self.words, self.codes = np.empty(0, np.int64), np.empty(0, np.int64)
        more = []
        for body in bodies:
            w, code, own, sizes = _unsqueeze(body, (2, 3, 4, 5))
            more.append((_counted(w)[0], code))
            if sum(x[0].size for x in more) > SHARD_TOKENS // 4:
                more = self._add_words(more)
            self.docs.append(np.flatnonzero(np.bincount(own >> 1)))
            self.cuts.append([0, *np.cumsum(sizes).tolist()])
        self._add_words(more)
        self.first = np.cumsum([0, *(d.size for d in self.docs)])
        self.size = int(self.words.max(initial=0)) + 1
        #: The two-grams of words split within the group, and how often they were trained on.
        self.pair, self.count = np.empty(0, np.int64), np.empty(0)
        for j in range(shards if shards > 1 else 0):
            for key, u, w, own, doc in self.tokens(j):
                del u, doc
                part = key & ((1 << _PARTS) - 1)
                near = np.flatnonzero((part > 0) & (part < _WIDE) & (own & 1 > 0))
                pair, n = _counted((key[near] >> _PARTS) * self.size + w[near])
                del key, w, own, part, near
                self.pair, place = _placed(np.concatenate([self.pair, pair]))
                self.count = np.bincount(place, weights=np.concatenate([self.count, n]), minlength=self.pair.size)

    def _add_words(self, more: list[tuple[np.ndarray, np.ndarray]]) -> list:
        code = np.concatenate([self.codes, *(c for _, c in more)])
        self.words, place = _placed(np.concatenate([self.words, *(w for w, _ in more)]))
        self.codes = np.empty(self.words.size, np.int64)
        self.codes[place] = code
        return []

    def tokens(self, shard: int) -> Iterator[list[np.ndarray]]:
        """(key, u, w, document of the block and whether it is trained on, document of the group) of the shard's tokens.

        A shard that came out larger than planned is given in several ranges of keys: contexts don't depend on each other.
        """
        here = [(body, slice(cut[shard], cut[shard + 1]), docs, first) for body, cut, docs, first in
                zip(self.bodies, self.cuts, self.docs, self.first.tolist()) if cut[shard] < cut[shard + 1]]
        size = sum(x.stop - x.start for _, x, *_ in here)
        ranges = -(-size // SHARD_TOKENS)
        bounds = []
        if ranges > 1:
            every = np.sort(np.concatenate([np.cumsum(_unsqueeze(body, (0,), x)[0]) for body, x, *_ in here]))
            bounds = np.unique(every[np.arange(1, ranges) * size // ranges]).tolist()
            del every
        for low, high in zip([0, *bounds], [*bounds, 1 << 63]):
            out = []
            for body, x, docs, first in here:
                key = np.cumsum(_unsqueeze(body, (0,), x)[0])
                a = int(np.searchsorted(key, low)) if low else 0
                b = int(np.searchsorted(key, high)) if high < 1 << 63 else key.size
                if a < b:
                    u, w, own = _unsqueeze(body, (1, 2, 4), slice(x.start + a, x.start + b))
                    place = np.empty(docs[-1] + 1, np.int64)
                    place[docs] = np.arange(first, first + docs.size)
                    out.append((key[a:b], u, w, own, place[own >> 1]))
            if out:
                whole = [[np.concatenate(c) for c in zip(*out)]]
                del out
                yield whole.pop()  # not held here

    def two_grams(self, name: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
        """(words in ascending order, counts) after a split word, in the whole corpus."""
        if not wide:
            a, b = np.searchsorted(self.pair, [name * self.size, (name + 1) * self.size])
            return self.pair[a:b] - name * self.size, self.count[a:b]
        store, path = file_system(self.wide)
        if store.get_file_info(f"{path}/v={name}").type == fs.FileType.NotFound:  # never before a word of training
            return np.empty(0, np.int64), np.empty(0)
        rows = pq.read_table(f"{path}/v={name}", columns=["body"], filesystem=store, partitioning=None)["body"]
        step, n = zip(*(_unsqueeze(x) for x in _bytes(rows)))
        word, n = np.concatenate([np.cumsum(x) for x in step]), np.concatenate(n)
        if len(step) > 1:
            order = np.argsort(word)
            word, n = word[order], n[order]
        return word, n.astype(float)


def _lookup(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The place of each value in an ascending table, or -1."""
    at = np.searchsorted(table, values)
    at[at == table.size] = 0
    return np.where(table[at] == values, at, -1) if table.size else np.full(values.size, -1)


class Grams:
    """The distinct contexts, two-grams, histories and three-grams of a shard's tokens, and how often they were trained on.

    A context's two-gram counts are those of the whole word if it is split; the two-grams are those of the tokens.
    """

    def __init__(self, tokens: list[np.ndarray], group: Messages):
        key, u, w, own, self.doc = tokens
        tokens.clear()
        learn = (own & 1).astype(float)
        first, run = runs(key)
        self.names, context = _placed(first)
        context = np.repeat(context, run)
        del key, own, first, run
        size, n = group.size, self.names.size
        pair, in_pair = _placed(context * size + w)
        del w
        self.context, self.word = pair // size, pair % size
        self.n2 = np.bincount(in_pair, weights=learn, minlength=pair.size)
        self.kinds2 = np.bincount(self.context[self.n2 > 0], minlength=n)
        self.total2 = np.bincount(self.context, weights=self.n2, minlength=n)
        part = self.names & ((1 << _PARTS) - 1)
        bound = np.searchsorted(self.context, np.arange(n + 1))
        for i in np.flatnonzero(part).tolist():
            word, count = group.two_grams(int(self.names[i]) >> _PARTS, bool(part[i] >= _WIDE))
            at = _lookup(word, self.word[bound[i] : bound[i + 1]])
            self.n2[bound[i] : bound[i + 1]] = np.where(at >= 0, count[at], 0) if count.size else 0
            self.kinds2[i], self.total2[i] = word.size, count.sum()
        word, place = _placed(self.word)
        self.log_chance = -group.codes[np.searchsorted(group.words, word)][place] / _STEP
        spread = int(u.max(initial=0)) + 1
        history, in_history = _placed(context * spread + u)
        del u, context
        self.above, self.before = history // spread, history % spread
        self.total3 = np.bincount(in_history, weights=learn, minlength=history.size)
        in_pair += in_history * pair.size
        triple, self.of = _placed(in_pair)
        del in_pair, in_history
        self.history, self.pair = triple // max(pair.size, 1), triple % max(pair.size, 1)
        self.n3 = np.bincount(self.of, weights=learn, minlength=triple.size)
        self.kinds3 = np.bincount(self.history[self.n3 > 0], minlength=history.size)
        # the start of a text is split by document: its two-grams are its three-grams
        begun = (self.names >> _PARTS == _START) & (part > 0)
        if begun.any():
            whole = begun[self.above]
            self.total3[whole], self.kinds3[whole] = self.total2[self.above[whole]], self.kinds2[self.above[whole]]
            same = whole[self.history]
            self.n3[same] = self.n2[self.pair[same]]


def build_trie(g: Grams) -> list[np.ndarray]:
    """The levels of a shard: what was trained on."""
    names, pairs, histories, triples = (np.flatnonzero(x > 0) for x in (g.total2, g.n2, g.total3, g.n3))
    rank = np.empty(g.names.size, np.int64)
    rank[names] = np.arange(names.size)
    total, context = g.total2[names], rank[g.context[pairs]]
    weight2 = DISCOUNT_2 * g.kinds2[names] / total
    p2 = np.empty(g.n2.size)
    p2[pairs] = (g.n2[pairs] - DISCOUNT_2) / total[context] + weight2[context] * 10 ** g.log_chance[pairs]
    first = np.searchsorted(context, np.arange(names.size + 1))
    place, among = np.empty(g.n2.size, np.int64), np.empty(g.total3.size, np.int64)
    place[pairs] = np.arange(pairs.size) - first[context]
    among[histories] = np.arange(histories.size)
    above, of = rank[g.above[histories]], among[g.history[triples]]
    weight3 = DISCOUNT_3 * g.kinds3[histories] / g.total3[histories]
    below = g.pair[triples]
    p3 = (g.n3[triples] - DISCOUNT_3) / g.total3[histories][of] + weight3[of] * p2[below]
    return [*EliasFano.build(g.names[names]), *quantised(np.log10(weight2)),
            *Level.build(first, g.word[pairs], np.log10(p2[pairs])),
            *Level.build(np.searchsorted(above, np.arange(names.size + 1)), g.before[histories], np.log10(weight3)),
            *Level.build(np.searchsorted(of, np.arange(histories.size + 1)), place[below], np.log10(p3))]


class Trie:
    """A shard's levels, read from a mapped buffer."""

    def __init__(self, parts: list[np.ndarray]):
        self.names = EliasFano.load(parts[0:3])
        self.codes, self.book = parts[3].view(np.uint8), parts[4].view(np.float64)
        self.words, self.histories, self.triples = (Level(parts[a : a + Level.PARTS]) for a in (5, 13, 21))

    def score(self, g: Grams) -> np.ndarray:
        """log10 probability of the last word of each three-gram after the other two."""
        at = self.names.successor(g.names)
        ok = np.flatnonzero(at < self.names.n)
        ok = ok[self.names.get(at[ok]) == g.names[ok]]
        context, weight = np.full(g.names.size, -1), np.zeros(g.names.size)
        context[ok], weight[ok] = at[ok], self.book[self.codes[at[ok]]]
        two = g.log_chance + weight[g.context]
        place, rank = self.words.find(context[g.context], g.word)
        hit = np.flatnonzero(place >= 0)
        two[hit] = self.words.value(place[hit])
        history, _ = self.histories.find(context[g.above], g.before)
        back, hit = np.zeros(history.size), np.flatnonzero(history >= 0)
        back[hit] = self.histories.value(history[hit])
        out = two[g.pair] + back[g.history]
        ranks = rank[g.pair]
        three, _ = self.triples.find(np.where(ranks >= 0, history[g.history], -1), np.maximum(ranks, 0))
        hit = np.flatnonzero(three >= 0)
        out[hit] = self.triples.value(three[hit])
        return out


def store_trie(parts: list[np.ndarray], folder: str, name: str) -> tuple[fs.FileSystem, str]:
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}", compression=None) as sink:
        sink.write(to_bytes(parts))
    return store, f"{path}/{name}"


def open_trie(store: fs.FileSystem, path: str) -> Trie:
    """The trie of a file: mapped into memory where the store is a file system, else read."""
    if isinstance(store, fs.LocalFileSystem):
        data = np.memmap(path, np.uint8, "r")
    else:
        data = np.frombuffer(store.open_input_file(path).read(), np.uint8)
    return Trie(from_buffer(data))


def shard_scores(asked: DataFrame, folder: str, keep: bool, words: Unigrams, wide: str | None) -> DataFrame:
    """(block, kind, docs, sums): log probabilities by document of each block, from the tries of each group of shards."""
    size, single = words.group, words.shards == words.group

    def score(group: pa.Table) -> pa.Table:
        number = group["shard"][0].as_py()
        names, kinds, bodies = group["block"].to_pylist(), group["kind"].to_pylist(), _bytes(group["body"])
        out = [(b, 1, b"", bytes(x)) for b, k, x in zip(names, kinds, bodies) if k]
        plain = [(b, x) for b, k, x in zip(names, kinds, bodies) if not k]
        attempt = TaskContext.get().taskAttemptId()
        messages = Messages([x for _, x in plain], size, wide)
        sums = np.zeros(int(messages.first[-1]))
        for j in range(size):
            k = 0
            for got in messages.tokens(j):
                grams = Grams(got, messages)
                name = f"shard-{number * size + j}" + (f"-{k}" if k else "")
                store, path = store_trie(build_trie(grams), folder, f"{name}.trie" if keep else f"{name}-{attempt}.trie")
                try:
                    got = open_trie(store, path).score(grams)
                finally:
                    if not keep:
                        store.delete_file(path)
                sums += np.bincount(grams.doc, weights=got[grams.of], minlength=sums.size)
                k += 1
                del got, grams
        for (name, _), docs, a, b in zip(plain, messages.docs, messages.first.tolist(), messages.first[1:].tolist()):
            if docs.size:
                part = sums[a:b].astype(np.float32).tobytes() if single else _squeeze(np.round(np.maximum(-sums[a:b], 0) * _STEP).astype(np.int64))
                out.append((name, 0, _squeeze(docs), part))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "kind": pa.array([x[1] for x in out], pa.int32()),
                         "docs": _binary([x[2] for x in out]), "sums": _binary([x[3] for x in out])})

    return asked.groupBy("shard").applyInArrow(releasing_group(score), "block long, kind int, docs binary, sums binary")


def score_documents(docs: DataFrame, model_dir: str | None = None) -> DataFrame:
    """Train on the documents outside the held-out fold and score all; one row per row of ``docs``.

    ``model_dir``: a shared folder that keeps the shards' trie files; else they go when a shard is done.
    """
    spark = docs.sparkSession
    table = written(spark, blocks(docs), "lm-blocks", WIDE_ROWS)
    total = table.agg(F.sum("tokens"), F.sum("train_docs")).first()
    shards = max(1, -(-(total[0] or 0) // SHARD_TOKENS))
    folder = paged(spark, word_counts(table, -(-shards // PART_SHARDS)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, top = np.zeros(4, np.int64), 0
        for batch in batches:
            for x in field(batch, "counts").to_pylist():
                own, most = _unsqueeze(x)
                got, top = got + own, max(top, int(most[0]))
        yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in (*got, top)], list("abcde"))

    seen = spark.read.schema("block long, part int, counts binary, page long").parquet(folder).where("page = -1").select("counts").mapInArrow(add, "a long, b long, c long, d long, e long")
    *figures, top = (x or 0 for x in seen.agg(*(F.sum(c) for c in "abcd"), F.max("e")).first())
    words = Unigrams(*figures, total[1] or 0, shards)
    most = words.parts(np.array([max(top, words.train_docs)]))[0]
    wide = wide_pairs(table, folder, words) if most > words.group else None
    answered = shard_scores(requests(table, folder, words), model_dir or scratch_path(spark, "lm-tries"), model_dir is not None, words, wide)
    single = words.shards == words.group

    def finish(block: pa.Table, sums: pa.Table) -> pa.Table:
        names = block["doc_ids"][0].as_py()
        n = len(names)
        score = np.zeros(n)
        for kind, own, x in zip(*(sums[c].to_pylist() for c in ("kind", "docs", "sums"))):
            if kind:
                size, known, base, direct, train = np.frombuffer(x).reshape(5, n)
                score += direct
            else:
                score[_unsqueeze(own)[0]] += np.frombuffer(x, np.float32) if single else _unsqueeze(x)[0] / -_STEP
        return pa.table({"doc_id": pa.array(names, pa.int64()), "held_out": pa.array(train == 0),
                         "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
                         "train_tokens": pa.array([words.tokens] * n, pa.int64()), "base_score": pa.array(base), "score": pa.array(score)})

    return table.select("block", "doc_ids").groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(finish, RESULT)


def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
