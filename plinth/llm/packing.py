"""Lexical retrieval packing: documents that share rare terms fill a window together.

Documents are dealt to shards by content: a document's key is its rarest term that any other document
has, and keys in the order of their rarity are cut into shards of at most ``SHARD_DOCS`` documents and ``SHARD_TOKENS``
tokens, so documents that share a rare term meet wherever they were read.  A key with more than a shard's
documents is split over several shards.  Each shard has a BM25
inverted index over token ids; document frequencies and the mean length are those of the whole corpus.
A shard's first unused document seeds a window of ``window`` tokens; the index returns its unused
neighbours, best first (ties: the earlier document), which fill the window greedily.  The neighbour that
does not fit is cut, and its rest seeds the next window.  Documents of a whole window or more give whole
windows first; only what remains of them is packed.  A shard's last tokens are cut into sequences whose
lengths are powers of two, which need no padding.

The tokenised documents are written to the shared folder once, in blocks as they are read.  Two light passes
over them follow: the keys' documents and tokens (one row a key at most, as many as the vocabulary has), and one
shuffle of 16-bit ids to the shards.

Defined results: a null or empty text is the one end id; ties and repeated rows are packed like any
others; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm import pieces
from plinth.llm.graph import WIDE_ROWS, written
from plinth.llm.pieces import PieceIds
from plinth.llm.text import FILTER_BYTES, chunks, column_bytes, field, releasing, releasing_group, span_hashes, sums
from plinth.llm.words import WordIds, cut, joined, odd_bytes

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
WINDOW = 2048
SHARD_DOCS = 1024
#: Words that go to the library as one text.
JOINED = 500
#: New words that are learned at a time; the library's results take some 500 bytes a word.
NEW_WORDS = 5_000
SHARD_TOKENS = 2_000_000
K1, B = 1.2, 0.75
BLOCK_DOCS, BLOCK_TOKENS = 1024, 2_000_000
SHARDS = "doc_ids array<long>, lengths array<long>, ids binary, terms binary, counts binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer(PieceIds):
    """ids of texts by a tokenizer of lower-cased words; the library sees each distinct word once per worker.

    Plain Latin texts of a column are cut into words by their bytes, and words are known by 64-bit hashes.  Any other text is cut
    at white space (no token crosses it); its pieces of plain Latin text are cut into words by the tokenizer's own word
    pattern, restricted to those letters, and any other piece goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        known = self.library.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)
        self.ends[[i for token, i in known.items() if token.endswith("</w>")]] = True
        super().__init__(path)
        self.words = WordIds(pieces.CACHE_PIECES)

    def encode_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); a null text is empty."""
        data, off = column_bytes(col)
        n = off.size - 1
        buf = np.append(np.insert(data, off[:-1], 32), np.uint8(32))
        begin = off + np.arange(1, n + 2)
        odd = np.unique(np.searchsorted(begin, odd_bytes(buf), "right") - 1)
        for i in odd.tolist():
            buf[begin[i] : begin[i + 1] - 1] = 32
        buf, starts, ends = cut(buf)
        ids, size = self._plain(buf, starts, ends)
        count = sums(size, np.searchsorted(starts, begin))
        if odd.size:
            other, own = self.encode([col[i].as_py() for i in odd.tolist()])
            plain, count[odd] = ids, own
            of_odd = np.zeros(n, bool)
            of_odd[odd] = True
            of_odd = np.repeat(of_odd, count)
            ids = np.empty(of_odd.size, np.uint16)
            ids[of_odd], ids[~of_odd] = other, plain
        return ids, count

    def _plain(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = span_hashes(buf, starts, ends)
        entry = self.words.find(key)
        new, at = np.unique(key[entry < 0], return_index=True)
        if new.size:
            where = np.flatnonzero(entry < 0)[at]
            if self.words.room(new.size):
                entry = self.words.find(key)
                new, at = np.unique(key[entry < 0], return_index=True)
                where = np.flatnonzero(entry < 0)[at]
            for a in range(0, new.size, NEW_WORDS):
                part = where[a : a + NEW_WORDS]
                self.words.add(new[a : a + NEW_WORDS], *self._ids_of_spans(buf, starts[part], ends[part]))
            lost = np.flatnonzero(entry < 0)
            entry[lost] = self.words.find(key[lost])
        self.words.used(entry)
        return self.words.taken(entry)

    def _ids_of_spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = joined(buf, starts, ends, JOINED)
        ids = np.concatenate([np.array(e.ids, np.uint16) for e in self._encoded(texts)])
        to = np.flatnonzero(self.ends[ids]) + 1
        if to.size != starts.size:
            return self.ids_of(" ".join(texts).split())
        return ids, np.diff(to, prepend=0)

    def split(self, text: str) -> list[str]:
        if "<|" not in text and not _OTHER.search(text):
            return text.lower().split()
        return text.replace("\n", " ").split(" ")

    def words_of(self, piece: str) -> tuple[str, ...] | list[str]:
        return (piece,) if "<|" in piece or _OTHER.search(piece) else _WORD.findall(piece.lower())

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library gets many words as one text; the last id of each word is marked as a word's end.  Whatever it does
        not take as one word goes alone."""
        one = np.array([bool(_WORD.fullmatch(w)) and not _OTHER.search(w) and w == w.lower() for w in words], bool)
        joined = [w for w, x in zip(words, one) if x]
        texts = [" ".join(joined[i : i + JOINED]) for i in range(0, len(joined), JOINED)]
        ids = np.concatenate([np.empty(0, np.uint16), *(np.array(e.ids, np.uint16) for e in self._encoded(texts))])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if ends.size != len(joined):
            one[:], ids, ends = False, ids[:0], ends[:0]
        sizes = np.zeros(len(words), np.int64)
        sizes[one] = np.diff(ends, prepend=0)
        if one.all():
            return ids, sizes
        alone = [np.array(e.ids, np.uint16) for e in self._encoded([w for w, x in zip(words, one) if not x])]
        sizes[~one] = [x.size for x in alone]
        out, of_one = np.empty(sizes.sum(), np.uint16), np.repeat(one, sizes)
        out[of_one], out[~of_one] = ids, np.concatenate(alone)
        return out, sizes

    def _encoded(self, texts: list[str]) -> list:
        return self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []


# The word pattern of the tokenizer, its character classes spelt out below U+0130.
_LETTER, _DIGIT = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u012f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
# Beyond those classes, and controls that are white space to one side only.
_OTHER = re.compile("[\x1c-\x1f\u0130-\U0010ffff]")


def blocks(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """One row a block of documents: their ids (16 bits each, end id included) and the terms' document counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(path)

        def block(held: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
            owner = np.repeat(np.arange(len(held), dtype=np.uint32), [x.size for _, x in held])
            cells = np.sort(owner << np.uint32(16) | np.concatenate([x for _, x in held]))
            n = np.bincount(cells[np.append(True, cells[1:] != cells[:-1])] & np.uint32(0xFFFF), minlength=65536)
            terms = np.flatnonzero(n)
            counts = n[terms]
            return pa.RecordBatch.from_arrays(
                [pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                 pa.array([[x.size for _, x in held]], pa.list_(pa.int64())),
                 pa.array([b"".join(x.tobytes() for _, x in held)], pa.binary()),
                 pa.array([terms.astype(np.uint16).tobytes()], pa.binary()), pa.array([counts.astype(np.int64).tobytes()], pa.binary())],
                ["doc_ids", "lengths", "ids", "terms", "counts"])

        held, tokens = [], 0
        for batch in chunks(batches, most=FILTER_BYTES):
            ids, n = tokenizer.encode_column(field(batch, "text"))
            ends = np.cumsum(n)
            for doc, a, b in zip(field(batch, "doc_id").to_pylist(), ends - n, ends):
                own = np.append(ids[a:b], np.uint16(end_id))
                if held and (len(held) >= BLOCK_DOCS or tokens + own.size > BLOCK_TOKENS):
                    yield block(held)
                    held, tokens = [], 0
                held.append((doc, own))
                tokens += own.size
        if held:
            yield block(held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(rows), SHARDS)


def corpus_statistics(table: DataFrame) -> tuple[np.ndarray, int, int]:
    """(document count of each term, documents, tokens) of all blocks; one number per id of the vocabulary."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65536, np.int64)
        for batch in batches:
            for terms, counts in zip(field(batch, "terms"), field(batch, "counts")):
                total[np.frombuffer(terms.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["term", "n"])

    n = np.zeros(65536, np.int64)
    got = (table.select("terms", "counts").mapInArrow(add, "term int, n long")
           .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    n[got["term"]] = got["n"]
    both = table.select(F.sum(F.size("lengths")).alias("d"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("t")).first()
    return n, both["d"] or 0, both["t"] or 0


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, lengths, ids) of each block of a batch."""
    for names, lengths, ids in zip(field(batch, "doc_ids"), field(batch, "lengths"), field(batch, "ids")):
        yield names.as_py(), lengths.values.to_numpy(zero_copy_only=False), np.frombuffer(ids.as_buffer(), np.uint16)


def rarity(n: np.ndarray) -> np.ndarray:
    """The place of each term when terms that two documents or more have are ordered by rarity; all others come last."""
    order = np.lexsort((np.arange(n.size), n))
    place = np.empty(n.size, np.int32)
    place[order] = np.arange(n.size, dtype=np.int32)
    return np.where(n > 1, place, np.int32(n.size))


def _keys(lengths: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The key of each document: the place of its rarest term (every document has an id at least)."""
    return np.minimum.reduceat(place[ids], np.cumsum(lengths) - lengths)


def shard_plan(table: DataFrame, place: np.ndarray, docs: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shard, number of shards) of each key, from the keys' documents and tokens."""
    size = place.size + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, t = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for _, lengths, ids in _documents(batch):
                key = _keys(lengths, ids, place)
                d += np.bincount(key, minlength=size)
                np.add.at(t, key, lengths)
        used = np.flatnonzero(d)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(d[used]), pa.array(t[used])], ["key", "docs", "tokens"])

    got = table.select("doc_ids", "lengths", "ids").mapInArrow(add, "key int, docs long, tokens long").groupBy("key").agg(
        F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).orderBy("key").collect()  # a row a term at most
    first, parts = np.zeros(size, np.int64), np.ones(size, np.int64)
    at, d, t = 0, 0, 0
    for key, n_docs, n_tokens in got:
        need = max(-(-n_docs // docs), -(-n_tokens // tokens))
        if d and (need > 1 or d + n_docs > docs or t + n_tokens > tokens):
            at, d, t = at + 1, 0, 0
        first[key], parts[key] = at, need
        if need > 1:
            at += need
        else:
            d, t = d + n_docs, t + n_tokens
    return first, parts


def dealt(table: DataFrame, place: np.ndarray, first: np.ndarray, parts: np.ndarray) -> DataFrame:
    """(shard, key, doc_id, ids) of every document; those of a split key are dealt in turn."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for names, lengths, ids in _documents(batch):
                key = _keys(lengths, ids, place)
                ends = np.cumsum(lengths)
                shard = first[key] + (turn + np.arange(key.size)) % parts[key]
                turn += key.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), pa.array(key, pa.int32()), pa.array(names, pa.int64()),
                     pa.array([ids[b - n : b].tobytes() for b, n in zip(ends.tolist(), lengths.tolist())], pa.binary())], ["shard", "key", "doc_id", "ids"])

    return table.select("doc_ids", "lengths", "ids").mapInArrow(rows, "shard long, key int, doc_id long, ids binary")


class Index:
    """BM25 over one shard: postings (document, weight) by term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean: float):
        n = lengths.size
        kind = np.uint32 if n <= 65536 else np.int64  # 16 bits of the id, the rest for the document
        cell = np.repeat(np.arange(n, dtype=kind), lengths)
        cell += ids.astype(kind) * kind(n)
        cell, tf = np.unique(cell, return_counts=True)
        self.n, self.doc = n, (cell % kind(n)).astype(np.int64)
        term = cell // kind(n)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.doc] / mean))
        self.terms, self.at = np.unique(term, return_index=True)
        self.at = np.append(self.at, cell.size)
        order = np.argsort(self.doc, kind="stable")
        self.own = np.searchsorted(self.terms, term[order])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=n))])

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document of the shard for the distinct terms of ``seed``."""
        own = self.own[self.first[seed] : self.first[seed + 1]]
        size = self.at[own + 1] - self.at[own]
        pick = np.repeat(self.at[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.doc[pick], weights=self.weight[pick], minlength=self.n)


def pack_shard(lengths: np.ndarray, scores, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length): full windows, then powers of two."""
    out = [[(d, a, window)] for d, n in enumerate(lengths) for a in range(0, n - window + 1, window)]
    at = lengths // window * window
    open_ = at < lengths
    held: list[tuple[int, int, int]] = []
    room, seed, next_ = window, -1, 0
    while True:
        if seed < 0:  # the rest of a cut document, else the first unused one
            while next_ < lengths.size and not open_[next_]:
                next_ += 1
            if next_ == lengths.size:
                break
            seed = next_
        score = None
        who, seed = seed, -1
        query = who
        while room:
            take = min(int(lengths[who] - at[who]), room)
            held.append((who, int(at[who]), take))
            at[who] += take
            room -= take
            open_[who] = at[who] < lengths[who]
            if open_[who]:
                seed = who
                break
            if room:
                if score is None:
                    score = scores(query)
                score[~open_] = -1.0
                who = int(np.argmax(score))
                if score[who] < 0:
                    break
        if not room:
            out.append(held)
            held, room = [], window
    # what is left of the shard: one sequence for each binary digit of its length
    left = window - room
    for digit in reversed(range(left.bit_length())):
        size, own = left & (1 << digit), []
        while size:
            d, a, n = held.pop(0)
            own.append((d, a, min(n, size)))
            if n > size:
                held.insert(0, (d, a + size, n - size))
            size -= min(n, size)
        if own:
            out.append(own)
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False,
         shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The pieces of all packed sequences; ``with_ids`` adds each piece's ids as an array."""
    spark = docs.sparkSession
    table = written(spark, blocks(docs, tokenizer or public_tokenizers.path(TOKENIZER), end_id), "tokenised", WIDE_ROWS)
    n, total, tokens = corpus_statistics(table)
    idf = np.log1p((total - n + 0.5) / (n + 0.5))
    mean = tokens / max(total, 1)
    place = rarity(n)
    first, parts = shard_plan(table, place, shard_docs, SHARD_TOKENS)

    def packed(shard: pa.Table) -> pa.Table:
        # equal keys lie together; among them ties are broken by content, then id
        texts, names = shard.column("ids").to_pylist(), shard.column("doc_id").to_pylist()
        key = shard.column("key").to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (key[i], zlib.crc32(texts[i]), -1 if names[i] is None else names[i]))
        texts, names = [texts[i] for i in order], [names[i] for i in order]
        lengths = np.array([len(x) // 2 for x in texts], np.int64)
        ids = np.frombuffer(b"".join(texts), np.uint16)
        index = Index(ids, lengths, idf, mean)
        begin = np.cumsum(lengths) - lengths
        number = shard.column("shard")[0].as_py() << 32
        out: dict[str, list] = {x.split()[0]: [] for x in PIECES.split(", ")}
        cut = []
        for k, sequence in enumerate(pack_shard(lengths, index.scores, window)):
            offset = 0
            for d, a, m in sequence:
                own = ids[begin[d] + a : begin[d] + a + m].astype("<u4")
                for name, value in zip(out, (names[d], a, m, zlib.crc32(own.tobytes()), int(lengths[d]), number + k, offset)):
                    out[name].append(value)
                offset += m
                if with_ids:
                    cut.append(own.astype(np.int32))
        columns = {name: pa.array(x, pa.int64()) for name, x in out.items()}
        return pa.table(columns | ({"ids": pa.array(cut, pa.list_(pa.int32()))} if with_ids else {}))

    return dealt(table, place, first, parts).groupBy("shard").applyInArrow(releasing_group(packed), PIECES + ", ids array<int>" * with_ids)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
