"""Byte-level BPE encoding by a pair occurrence index, and decoding.

New words of a batch stand in one symbol sequence with links to both neighbours.  An index maps every
pair that has a rank to all its positions.  Active ranks are taken in ascending order: all occurrences of
the pair are merged from left to right, and the pairs that a merge makes with its neighbours enter the
lists of their ranks.  A pair made by a merge always has a higher rank than that merge, so each rank is
taken once.

Text is cut at single spaces between other characters (no token crosses them), then by the vocabulary's
word pattern.  Special tokens in a text become their ids.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows are
encoded alike; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.pieces import PieceIds
from plinth.llm.text import chunks, field

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: the pattern that cuts text into words in byte-level vocabularies of this kind.
WORD = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_SPACES = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: From here on, character classes differ between versions of Unicode; the library's own pattern decides.
_NEWER = "\u0558"


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in own}
    for b in sorted(set(range(256)) - set(own)):
        out[b] = chr(0x100 + len(out) - len(own))
    return out


class Codec(PieceIds):
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, symbols = data["model"], byte_symbols()
        vocab = model["vocab"]
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.of_byte = [vocab[symbols[b]] for b in range(256)]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], (rank, vocab[a + b]))
        back = {c: b for b, c in symbols.items()}
        self.bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i) for i in range(len(self.bytes))]
        self.path = path
        self._library = None

    def split(self, text: str) -> list[str]:
        parts = self.marks.split(text) if self.marks and self.marks.search(text) else [text]
        out: list[str] = []
        for part in parts:
            if part in self.special:
                out.append(part)
            elif _SPACES.search(part):
                out += _CUT.split(part)
            else:
                own = part.split(" ")
                out.append(own[0])
                out += [" " + x for x in own[1:]]
        return out

    def words_of(self, piece: str) -> list[str]:
        if piece in self.special:
            return [piece]
        if max(piece, default="") < _NEWER:
            return WORD.findall(piece)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [piece[a:b] for _, (a, b) in self._library.pre_tokenize_str(piece)]

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        marks = self.special.keys() & set(words)
        if not marks:
            return self.merge([w.encode() for w in words])
        plain = [w for w in words if w not in marks]
        ids, size = self.merge([w.encode() for w in plain])
        own = dict(zip(plain, np.split(ids, np.cumsum(size)[:-1]))) | {w: np.array([self.special[w]], np.uint16) for w in marks}
        return np.concatenate([own[w] for w in words]), np.array([own[w].size for w in words])

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each): all merged together through the pair occurrence index."""
        if not words:
            return np.empty(0, np.uint16), np.zeros(0, np.int64)
        symbol = np.array(self.of_byte, np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum([len(w) for w in words])
        last = np.zeros(symbol.size, bool)
        last[ends - 1] = True
        place: dict[int, list[int]] = {}
        code = symbol[:-1] << 20 | symbol[1:]
        inner = np.flatnonzero(~last[:-1])
        order = inner[np.argsort(code[inner], kind="stable")]
        edges = np.flatnonzero(np.diff(code[order])) + 1
        active, rank_of = [], {}
        for own in np.split(order, edges) if order.size else ():
            pair = int(code[own[0]])
            if pair in self.ranks:
                place[pair] = own.tolist()
                rank = self.ranks[pair][0]
                rank_of[rank] = pair
                active.append(rank)
        heapq.heapify(active)
        n = symbol.size
        after = np.arange(1, n + 1)
        after[last] = -1
        before = np.arange(-1, n - 1)
        before[ends[:-1]] = -1
        sym, nxt, prv, ranks = symbol.tolist(), after.tolist(), before.tolist(), self.ranks
        get, push, pop = place.get, heapq.heappush, heapq.heappop
        while active:
            pair = rank_of[pop(active)]
            a, b, c = pair >> 20, pair & 0xFFFFF, ranks[pair][1]
            for at in place.pop(pair):
                right = nxt[at]
                if sym[at] != a or right < 0 or sym[right] != b:
                    continue  # an earlier merge took one of them
                sym[at], sym[right] = c, -1
                far = nxt[at] = nxt[right]
                near = prv[at]
                # the pairs with both neighbours enter their lists; a pair met first becomes active
                if far >= 0:
                    prv[far] = at
                    made = c << 20 | sym[far]
                    held = get(made)
                    if held is not None:
                        held.append(at)
                    elif made in ranks:
                        place[made] = [at]
                        rank_of[rank := ranks[made][0]] = made
                        push(active, rank)
                if near >= 0:
                    made = sym[near] << 20 | c
                    held = get(made)
                    if held is not None:
                        held.append(near)
                    elif made in ranks:
                        place[made] = [near]
                        rank_of[rank := ranks[made][0]] = made
                        push(active, rank)
        left = np.array(sym)
        kept = left >= 0
        size = np.add.reduceat(kept, ends - [len(w) for w in words])
        return left[kept].astype(np.uint16), size

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _each(batch: pa.RecordBatch, codec: Codec) -> Iterator[list[int]]:
    ids, n = codec.encode([x or "" for x in field(batch, "text").to_pylist()])
    ends = np.cumsum(n)
    for a, b in zip(ends - n, ends):
        yield ids[a:b].tolist()


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    path = path or public_tokenizers.path(VOCABULARY)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path)
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(list(_each(batch, codec)), pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    return _source(docs).mapInArrow(rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    path = path or public_tokenizers.path(VOCABULARY)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path)
        for batch in batches:
            text = [codec.decode(x.values.to_pylist() if x.is_valid else []) for x in field(batch, "ids")]
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of every row's ids and of the text decoded from them, in one pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path)
        for batch in chunks(batches):
            n, coded, decoded = [], [], []
            for ids in _each(batch, codec):
                n.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(codec.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(coded), pa.array(decoded)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs).mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
