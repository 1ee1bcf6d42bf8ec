"""Elias-Fano sequences and n-gram trie levels in flat byte buffers, so that a file of them can be memory-mapped."""

from __future__ import annotations

import numpy as np

_WORD = np.dtype("<u8")
#: So many children are looked up at a time.
SLICE = 1 << 17


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, one after the other, and 8 bytes of padding."""
    out = []
    for at in range(0, values.size, 1 << 16):  # multiples of 8 values fill whole bytes
        part = values[at : at + (1 << 16), None] >> np.arange(width, dtype=np.uint64)
        out.append(np.packbits((part & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, np.uint8)])


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.flatnonzero(np.unpackbits(high, bitorder="little"))[:n] if n else np.empty(0, np.int64)
        self.upper = ones - np.arange(n)
        # how many values have upper bits below 0, 1, 2, ...: where the values with given upper bits begin
        self.bucket = np.concatenate([[0], np.cumsum(np.bincount(self.upper, minlength=1)), [n]])

    @classmethod
    def build(cls, values: np.ndarray) -> list[np.ndarray]:
        """The sequence as flat parts (see ``load``)."""
        values = values.astype(np.uint64)
        n = values.size
        width = max(0, int(np.log2((int(values[-1]) + 1) / n))) if n else 0
        bits = np.zeros((int(values[-1]) >> width) + n + 1 if n else 1, np.uint8)
        if n:
            bits[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        return [np.array([n, width], np.int64), _pack(values, width), np.packbits(bits, bitorder="little")]

    @classmethod
    def load(cls, parts: list[np.ndarray]) -> "EliasFano":
        head = parts[0].view(np.int64)
        return cls(int(head[0]), int(head[1]), parts[1].view(np.uint8), parts[2].view(np.uint8))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(i.size, np.int64)
        words = np.ndarray((self.low.size - 7,), _WORD, buffer=self.low, strides=(1,))
        bit = i * self.width
        got = words[bit >> 3]
        got >>= (bit & 7).view(np.uint64)
        got &= np.uint64((1 << self.width) - 1)
        return got.view(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return self.upper[i] << self.width | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first value that is not less than each ``x``."""
        high, low = x >> self.width, x & ((1 << self.width) - 1)
        high = np.clip(high, 0, self.bucket.size - 2)
        out, end = self.bucket[high], self.bucket[high + 1]
        live = np.flatnonzero(out < end)
        a, b, low = out[live], end[live], low[live]
        while live.size:
            mid = (a + b) >> 1
            less = self._low(mid) < low
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            open_ = a < b
            done, left = np.flatnonzero(~open_), np.flatnonzero(open_)
            out[live.take(done)] = a.take(done)
            live, a, b, low = (c.take(left) for c in (live, a, b, low))
        return out


def quantised(values: np.ndarray, bits: int = 8) -> list[np.ndarray]:
    """(codes, code book): bins of equal population, each standing for its mean."""
    if not values.size:
        return [np.empty(0, np.uint8), np.zeros(1)]
    edges = np.unique(np.quantile(values, np.linspace(0, 1, (1 << bits) + 1)[1:-1]))
    codes = np.searchsorted(edges, values, "right")
    count = np.maximum(np.bincount(codes, minlength=edges.size + 1), 1)
    return [codes.astype(np.uint8), np.bincount(codes, weights=values, minlength=edges.size + 1) / count]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, length) of each run of equal neighbours."""
    first = np.flatnonzero(np.concatenate([np.ones(min(values.size, 1), bool), values[1:] != values[:-1]]))
    return values[first], np.diff(first, append=values.size)


class Level:
    """The children of each node of the level above: monotone pointers, ids relative to their context.

    The children's ids of one context after the other form one increasing sequence, each context's ids
    being shifted by what the contexts before it take.
    """

    PARTS = 8

    def __init__(self, parts: list[np.ndarray]):
        self.pointers, self.ids = EliasFano.load(parts[0:3]), EliasFano.load(parts[3:6])
        self.codes, self.book = parts[6].view(np.uint8), parts[7].view(np.float64)

    @classmethod
    def build(cls, first: np.ndarray, ids: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
        """``first``: where each context's children begin, and their number; ``ids`` increase in a context."""
        top = np.where(np.diff(first) > 0, ids[first[1:] - 1] + 1, 0) if ids.size else np.zeros(first.size - 1, np.int64)
        base = np.cumsum(top) - top
        shifted = ids + np.repeat(base, np.diff(first))
        return [*EliasFano.build(first), *EliasFano.build(shifted), *quantised(values)]

    def find(self, context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among all children or -1, place among the context's) of a child; context -1 has none."""
        out, rank = np.full(ids.size, -1), np.full(ids.size, -1)
        for at in range(0, ids.size if self.ids.n else 0, SLICE):
            part = slice(at, at + SLICE)
            self._find(context[part], ids[part], out[part], rank[part])
        return out, rank

    def _find(self, context: np.ndarray, ids: np.ndarray, out: np.ndarray, rank: np.ndarray) -> None:
        ok = np.flatnonzero(context >= 0)
        if not ok.size:
            return
        # tokens come by context: a run of equal ones is looked up once
        own, run = runs(context[ok])
        a, b = self.pointers.get(own), self.pointers.get(own + 1)
        base = np.where(a > 0, self.ids.get(np.maximum(a - 1, 0)) + 1, 0)
        a, b, base = (np.repeat(x, run) for x in (a, b, base))
        target = base + ids[ok]
        at = self.ids.successor(target)
        inside = np.flatnonzero(at < b)
        hit = inside[self.ids.get(at[inside]) == target[inside]]
        out[ok[hit]], rank[ok[hit]] = at[hit], at[hit] - a[hit]

    def value(self, place: np.ndarray) -> np.ndarray:
        return self.book[self.codes[place]]


def to_bytes(parts: list[np.ndarray]) -> bytes:
    """Parts with their sizes, each aligned to 8 bytes."""
    raw = [np.ascontiguousarray(p).view(np.uint8) for p in parts]
    sizes = np.array([len(raw), *(r.size for r in raw)], np.int64)
    return b"".join([sizes.tobytes(), *(r.tobytes() + b"\0" * (-r.size % 8) for r in raw)])


def from_buffer(data: np.ndarray) -> list[np.ndarray]:
    """The parts of a (memory-mapped) byte array, without copying."""
    n = int(data[:8].view(np.int64)[0])
    sizes = data[8 : 8 + 8 * n].view(np.int64)
    at = 8 * (1 + n) + np.concatenate([[0], np.cumsum((sizes + 7) // 8 * 8)])
    return [data[at[i] : at[i] + sizes[i]] for i in range(n)]
