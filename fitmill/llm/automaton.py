"""A generalised suffix automaton."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Automaton:
    """A suffix automaton of several sequences. Of each state: moves, longest length, suffix link."""

    moves: list[dict[int, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])

    def _state(self, moves: dict[int, int], length: int, link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.moves) - 1

    def _split(self, p: int, symbol: int) -> int:
        """The state for exactly the word of p with the symbol behind it, parted from a longer one if need be."""
        q = self.moves[p][symbol]
        if self.length[q] == self.length[p] + 1:
            return q
        short = self._state(dict(self.moves[q]), self.length[p] + 1, self.link[q])
        self.link[q] = short
        while p >= 0 and self.moves[p].get(symbol) == q:
            self.moves[p][symbol] = short
            p = self.link[p]
        return short

    def extend(self, last: int, symbol: int) -> int:
        if symbol in self.moves[last]:
            return self._split(last, symbol)
        new, p = self._state({}, self.length[last] + 1, 0), last
        while p >= 0 and symbol not in self.moves[p]:
            self.moves[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, symbol)
        return new

    def add(self, sequence: list[int]) -> list[int]:
        """Feeds a sequence; after each symbol, the length of the longest match that ends with it and began earlier."""
        last, earlier = 0, []
        for k, symbol in enumerate(sequence):
            known = symbol in self.moves[last]
            last = self.extend(last, symbol)
            earlier.append(k + 1 if known else self.length[self.link[last]])
        return earlier

    def step(self, state: int, length: int, symbol: int) -> tuple[int, int]:
        """State and length of the longest match that ends with the symbol."""
        while state and symbol not in self.moves[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.moves[state].get(symbol)
        return (0, 0) if to is None else (to, length + 1)
