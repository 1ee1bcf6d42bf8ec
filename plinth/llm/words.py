"""Words of plain Latin text cut from bytes by NumPy, and a worker's memory of their token ids by hash."""

from __future__ import annotations

import numpy as np

from plinth.llm.text import LOWER, SPACE

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[SPACE] = _SPACE
_KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
# Lower-cased characters U+0080 to U+012F, by lead byte (C2, C3, C4) and continuation.
_WIDE = np.full((3, 64), _OTHER, np.uint8)
_WIDE[0, [0x05, 0x20]] = _SPACE
_WIDE[0, [0x2A, 0x35, 0x3A]] = _LETTER
_WIDE[0, [0x32, 0x33, 0x39, 0x3C, 0x3D, 0x3E]] = _DIGIT
_WIDE[1, 0x1F:] = _LETTER
_WIDE[1, 0x37] = _OTHER
_WIDE[2, :0x30] = _LETTER


def odd_bytes(buf: np.ndarray) -> np.ndarray:
    """Where characters from U+0130 on, the controls U+001C to U+001F or a "<|" stand."""
    odd = (buf >= 0xC5) | ((buf >= 0x1C) & (buf <= 0x1F))
    odd[:-1] |= (buf[:-1] == 0xC4) & (buf[1:] >= 0xB0) | (buf[:-1] == ord("<")) & (buf[1:] == ord("|"))
    return np.flatnonzero(odd)


def cut(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends) of the words 's|'t|'re|'ve|'m|'ll|'d|letters|one digit|others of a buffer without
    odd bytes that begins and ends with a space."""
    buf = LOWER[buf]
    kind = _KIND[buf]
    lead = np.flatnonzero(buf >= 0xC2)
    if lead.size:
        row, low = buf[lead] - np.uint8(0xC2), buf[lead + 1] & np.uint8(0x3F)
        low += np.where((row == 1) & (low < 0x1F) & (low != 0x17), 0x20, (row == 2) & (low % 2 == 0)).astype(np.uint8)
        buf[lead + 1] = low | np.uint8(0x80)
        kind[lead] = kind[lead + 1] = _WIDE[row, low]
    first = np.ones(buf.size, bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    first[lead + 1] = False
    mark = np.flatnonzero(buf == ord("'"))
    mark = mark[(kind[mark - 1] != _OTHER) & (kind[mark + 1] == _LETTER)]
    if mark.size:
        a, b = buf[mark + 1], buf[mark + 2]
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        own = np.where(two, 3, np.where(np.isin(a, np.frombuffer(b"stmd", np.uint8)), 2, 0))
        mark, own = mark[own > 0], own[own > 0]
        first[mark + 1] = False
        after = mark + own
        first[after[kind[after] == _LETTER]] = True
    at = np.flatnonzero(first)
    word = kind[at] != _SPACE
    return buf, at[word], np.append(at[1:], buf.size)[word]


def joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> list[str]:
    """The words as texts of at most ``most`` words with a space after each."""
    size = ends - starts + 1
    to = np.cumsum(size)
    out = buf[np.minimum(np.repeat(starts - (to - size), size) + np.arange(size.sum()), buf.size - 1)]
    out[to - 1] = 32
    data = out.tobytes()
    bounds = [0, *to[most - 1 :: most].tolist()]
    bounds += [len(data)] * (bounds[-1] < len(data))
    return [data[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])]


def _longer(values: np.ndarray, size: int) -> np.ndarray:
    """The values with room behind them, whose memory is not taken before it is used."""
    out = np.empty(size, values.dtype)
    out[: values.size] = values
    return out


class WordIds:
    """Token ids of words by their 64-bit hashes: at most ``most`` words, or what one batch needs.

    When new words would not fit, those used again since they were learned stay, the most used ones first and half of the room
    at most; if they would still not fit, all go.
    """

    def __init__(self, most: int):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.n = 0
        self.key, self.uses = np.empty(1 << 12, np.uint64), np.zeros(1 << 12, np.int64)
        self.start = np.zeros((1 << 12) + 1, np.int64)
        self.ids = np.empty(1 << 16, np.uint16)
        self._table(1 << 14)

    def _table(self, size: int) -> None:
        self.slot = np.full(size, -1, np.int32)
        self._enter(np.arange(self.n))

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(65 - self.slot.size.bit_length())).astype(np.int64)

    def _enter(self, entry: np.ndarray) -> None:
        at = self._home(self.key[entry])
        while entry.size:
            free = self.slot[at] < 0
            self.slot[at[free]] = entry[free]
            left = self.slot[at] != entry
            entry, at = entry[left], (at[left] + 1) & (self.slot.size - 1)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 for an unknown one."""
        at = self._home(key)
        out = self.slot[at].astype(np.int64)
        open_ = np.flatnonzero((out >= 0) & (self.key[out] != key))
        at = at[open_]
        while open_.size:
            at = (at + 1) & (self.slot.size - 1)
            out[open_] = got = self.slot[at]
            left = (got >= 0) & (self.key[got] != key[open_])
            open_, at = open_[left], at[left]
        return out

    def room(self, new: int) -> bool:
        """Make room for new words; True if others were forgotten."""
        if not self.n or self.n + new <= self.most:
            return False
        uses = self.uses[: self.n]
        keep = np.flatnonzero(uses > 1)
        if keep.size > self.most // 2:
            keep = keep[np.argsort(-uses[keep], kind="stable")[: self.most // 2]]
        if keep.size + new > self.most:
            keep = keep[:0]
        key, uses, (ids, size) = self.key[keep], uses[keep], self.taken(keep)
        self._clear()
        self.add(key, ids, size)
        self.uses[: self.n] = uses // 2
        return True

    def add(self, key: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        n, to = self.n, self.n + key.size
        ends = self.start[n] + np.cumsum(size, dtype=np.int64)
        last = int(ends[-1]) if ends.size else int(self.start[n])
        if last > self.ids.size:
            self.ids = _longer(self.ids, max(2 * self.ids.size, last))
        if to > self.key.size:
            most = max(2 * self.key.size, to)
            self.key, self.uses, self.start = _longer(self.key, most), _longer(self.uses, most), _longer(self.start, most + 1)
        self.ids[self.start[n] : last] = ids
        self.key[n:to], self.uses[n:to], self.start[n + 1 : to + 1] = key, 0, ends
        self.n = to
        if 2 * to > self.slot.size:
            self._table(1 << (4 * to).bit_length())
        else:
            self._enter(np.arange(n, to))

    def taken(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the entries one after the other, number of ids of each)."""
        size = self.start[entry + 1] - self.start[entry]
        return self.ids[np.repeat(self.start[entry] - (np.cumsum(size) - size), size) + np.arange(size.sum())], size

    def used(self, entry: np.ndarray) -> None:
        self.uses[: self.n] += np.bincount(entry, minlength=self.n)
