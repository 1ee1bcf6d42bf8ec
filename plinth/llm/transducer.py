"""Weighted finite-state transducers over token classes, and their composition."""

from __future__ import annotations

from collections import deque


class Transducer:
    """Deterministic: ``arcs[state][symbol] = (next state, output symbol, weight)``; state 0 starts.

    A symbol without an arc keeps the state and passes through with weight 1.
    """

    def __init__(self, arcs: dict[object, dict[str, tuple[object, str, float]]]):
        self.arcs = arcs

    def step(self, state, symbol: str):
        return self.arcs.get(state, {}).get(symbol, (state, symbol, 1.0))

    def compose(self, after: "Transducer", symbols: str) -> "Transducer":
        """The transducer that reads ``symbols`` and feeds its outputs to ``after``; weights multiply.

        Only pairs of states that can be reached from the two starts are built, numbered from 0.
        """
        number, queue, arcs = {(0, 0): 0}, deque([(0, 0)]), {}
        while queue:
            pair = queue.popleft()
            own = arcs.setdefault(number[pair], {})
            for x in symbols:
                p, y, w = self.step(pair[0], x)
                q, z, v = after.step(pair[1], y)
                if (p, q) not in number:
                    number[p, q] = len(number)
                    queue.append((p, q))
                own[x] = (number[p, q], z, w * v)
        return Transducer(arcs)


def countdown(mark: str, span: int, symbols: str, change: dict[str, tuple[str, float]]) -> Transducer:
    """After ``mark``, for the next ``span`` symbols, a symbol in ``change`` becomes (output, weight)."""
    arcs = {}
    for left in range(span + 1):
        arcs[left] = {x: (span if x == mark else max(left - 1, 0), *(change[x] if left and x in change else (x, 1.0)))
                      for x in symbols}
    return Transducer(arcs)
