"""Token ids of whole texts from a per-worker memory of pieces."""

from __future__ import annotations

import numpy as np

from plinth.llm.text import sums

#: Entries (pieces and their words) that a worker remembers, some 200 bytes each.
CACHE_PIECES = 600_000


class PieceIds:
    """Ids of texts, where a text is cut into pieces and a piece into words that tokenise independently.

    Subclasses give ``split`` (the pieces of a text), ``words_of`` (the words of a piece) and ``ids_of``
    (the ids of new words).  A worker remembers at most ``CACHE_PIECES`` entries (pieces and words), or what one batch
    needs.  When the next batch would not fit, the entries that were used again since they were learned move to
    the older generation, the most used ones first and half of the room at most, and the rest are forgotten.
    """

    _own: dict[tuple[type, str], "PieceIds"] = {}

    def __init__(self, path: str):
        self.clear()

    @classmethod
    def of(cls, path: str):
        """This worker's instance for a vocabulary file, with what it remembers."""
        if (cls, path) not in cls._own:
            cls._own[cls, path] = cls(path)
        return cls._own[cls, path]

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint16)
        self.start = np.zeros(1 << 12, np.int64)
        self.uses = np.zeros(1 << 12, np.int64)

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def words_of(self, piece: str) -> tuple[str, ...] | list[str]:
        raise NotImplementedError

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each)."""
        raise NotImplementedError

    def _add(self, new: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n = len(self.known)
        ends = self.start[n] + np.cumsum(size, dtype=np.int64)
        if ends.size and ends[-1] > self.ids.size:
            self.ids = np.resize(self.ids, max(2 * self.ids.size, int(ends[-1])))
        if n + len(new) >= self.start.size:
            room = max(2 * self.start.size, n + len(new) + 1)
            self.start, self.uses = np.resize(self.start, room), np.resize(self.uses, room)
        if new:
            self.ids[self.start[n] : ends[-1]] = ids
            self.start[n + 1 : n + 1 + len(new)] = ends
            self.uses[n : n + len(new)] = 0
            self.known.update(zip(new, range(n, n + len(new))))

    def _recall(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the entries one after the other, number of ids of each); they count as used."""
        at = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        self.uses[: len(self.known)] += np.bincount(at, minlength=len(self.known))
        return self._taken(at)

    def _taken(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.start[at + 1] - self.start[at]
        return self.ids[np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())], size

    def _forget(self) -> None:
        """Keep the entries that were used more than once, the most used first, half of the room at most."""
        n = len(self.known)
        used = self.uses[:n]
        keep = np.flatnonzero(used > 1)
        if keep.size > CACHE_PIECES // 2:
            keep = np.sort(keep[np.argsort(-used[keep], kind="stable")[: CACHE_PIECES // 2]])
        names, kept = list(self.known), self._taken(keep)
        self.clear()
        self._add([names[i] for i in keep.tolist()], *kept)
        self.uses[: keep.size] = used[keep] // 2

    def _missing(self, pieces: set[str]) -> tuple[list[str], list, list[str]]:
        """(pieces without ids, the words of each, words without ids)."""
        new = list(pieces.difference(self.known))
        cut = [self.words_of(x) for x in new]
        return new, cut, list({w for own in cut for w in own}.difference(self.known))

    def _learn(self, pieces: set[str]) -> None:
        new, cut, fresh = self._missing(pieces)
        if len(self.known) + len(fresh) + sum(len(own) > 1 for own in cut) > CACHE_PIECES:
            self._forget()
            new, cut, fresh = self._missing(pieces)
            if self.known and len(self.known) + len(fresh) + sum(len(own) > 1 for own in cut) > CACHE_PIECES:
                self.clear()
                new, cut, fresh = self._missing(pieces)
        for at in range(0, len(fresh), 20_000):
            self._add(fresh[at : at + 20_000], *self.ids_of(fresh[at : at + 20_000]))
        rest = [(x, own) for x, own in zip(new, cut) if x not in self.known]
        ids, size = self._recall([w for _, own in rest for w in own])
        self._add([x for x, _ in rest], ids, sums(size, np.cumsum([0, *(len(own) for _, own in rest)])))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        pieces: list[str] = []
        count = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = self.split(text)
            count[i] = len(own)
            pieces += own
        self._learn(set(pieces))
        if not pieces:
            return np.empty(0, np.uint16), np.zeros(len(texts), np.int64)
        ids, size = self._recall(pieces)
        return ids, sums(size, np.concatenate([[0], np.cumsum(count)]))
