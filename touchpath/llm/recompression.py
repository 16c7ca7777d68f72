"""A run-length grammar of many sequences by recompression, and how far two places of them agree.

Rounds alternate. A block round replaces each stretch of equal symbols by one symbol for (symbol, length); a pair round
deals the symbols to a left and a right side and replaces each left one followed by a right one by one symbol for the
pair. Equal stretches are parsed equally but for a symbol at either end in each round, so two places are compared by
climbing from round to round while what stands there is equal, and by descending where it first differs: at each round
at most one symbol, or the shorter of two blocks, agrees. Both are done for all queries at once, in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from touchpath.llm.common import mix64

_SEED = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Round:
    """Symbols before a round, the new symbol that each became part of, and where each new symbol begins."""

    block: bool
    symbols: np.ndarray
    parent: np.ndarray
    begin: np.ndarray

    def mirrored(self) -> Round:
        size, new = len(self.symbols), len(self.begin) - 1
        return Round(self.block, self.symbols[::-1], (new - 1 - self.parent)[::-1], (size - self.begin)[::-1])


class Grammar:
    """The grammar of sequences of numbers, laid end to end with a separator before, between and after them.

    ``offsets`` are the places of the sequences' first numbers; separators agree with nothing, so that no two places
    agree beyond the end of their sequence.
    """

    def __init__(self, sequences: list[np.ndarray]):
        # separators are the negative numbers: they differ from each other and take no part in any round
        lengths = np.array([len(sequence) for sequence in sequences], np.int64)
        self.offsets = np.cumsum(lengths + 1) - lengths
        self.text = np.empty(int(lengths.sum()) + len(sequences) + 1, np.int64)
        self.text[0] = -1
        for number, (sequence, offset) in enumerate(zip(sequences, self.offsets)):
            self.text[offset : offset + len(sequence)] = sequence
            self.text[offset + len(sequence)] = -2 - number
        self.rounds: list[Round] = []
        symbols, self._next, number = self.text, int(self.text.max(initial=0)) + 1, 0
        while len(symbols) > 2 * len(sequences) + 1 or np.any((symbols[1:] >= 0) & (symbols[:-1] >= 0)):
            symbols = self._blocks(symbols)
            symbols = self._pairs(symbols, number)
            number += 1
        self.top = symbols
        self._back: list[Round] | None = None

    def _close(self, block: bool, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        begin = np.flatnonzero(first)
        self.rounds.append(Round(block, symbols, np.cumsum(first) - 1, np.append(begin, len(symbols))))
        return begin

    def _blocks(self, symbols: np.ndarray) -> np.ndarray:
        first = np.ones(len(symbols), bool)
        first[1:] = symbols[1:] != symbols[:-1]
        if first.all():
            return symbols
        begin = self._close(True, symbols, first)
        length = np.diff(np.append(begin, len(symbols)))
        new = symbols[begin]
        many = length > 1
        new[many] = self._named(new[many], length[many])
        return new

    def _pairs(self, symbols: np.ndarray, number: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            right = (mix64(symbols.astype(np.uint64) + _SEED * np.uint64(number + 1)) & np.uint64(1)).astype(bool)
        real = symbols >= 0
        inside = real[:-1] & real[1:]
        rising = inside & ~right[:-1] & right[1:]
        falling = inside & right[:-1] & ~right[1:]
        paired = rising if rising.sum() >= falling.sum() else falling
        if not paired.any():
            return symbols
        first = np.ones(len(symbols), bool)
        first[1:] = ~paired
        begin = self._close(False, symbols, first)
        new = symbols[begin]
        heads = np.flatnonzero(paired)
        new[self.rounds[-1].parent[heads]] = self._named(symbols[heads], symbols[heads + 1])
        return new

    def _named(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """A new symbol for each distinct pair of numbers."""
        width = int(two.max()) + 1
        if int(one.max()) < 2**62 // width:
            names = np.unique(one * width + two, return_inverse=True)[1]
        else:
            names = np.unique(np.stack([one, two]), axis=1, return_inverse=True)[1]
        names = names.reshape(-1) + self._next
        self._next = int(names.max()) + 1
        return names

    def ahead(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols from the places ``one`` on equal those from ``two`` on. Two places lie in one
        sequence and differ."""
        return _agreement(self.rounds, self.top, one, two)

    def behind(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols before the places ``one`` equal those before ``two``, counted backwards."""
        if self._back is None:
            self._back = [each.mirrored() for each in self.rounds]
        last = len(self.text)
        return _agreement(self._back, self.top[::-1], last - one, last - two)


def _agreement(rounds: list[Round], top: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    at, to = one.astype(np.int64), two.astype(np.int64)
    height = np.zeros(len(at), np.int64)  # the round in which a query met its first difference
    active = np.arange(len(at))
    for number, each in enumerate(rounds):
        i, j = at[active], to[active]
        symbol = each.symbols[i]
        equal = symbol == each.symbols[j]
        height[active[~equal]] = number
        active, i, j = active[equal], i[equal], j[equal]
        if not len(active):
            break
        up, other = each.parent[i], each.parent[j]
        middle = (each.begin[up] != i) | (each.begin[other] != j)
        if middle.any():
            left, beside = each.begin[up + 1] - i, each.begin[other + 1] - j
            if each.block:
                step = np.where(middle, np.minimum(left, beside), 0)
                ends = middle & (left != beside)  # the longer block goes on where the shorter one has ended
            else:
                step, ends = middle.astype(np.int64), np.zeros(len(i), bool)
            at[active], to[active] = i + step, j + step
            height[active[ends]] = number
            active, up, other, middle = active[~ends], up[~ends], other[~ends], middle[~ends]
        at[active], to[active] = up + middle, other + middle
    else:
        height[active] = len(rounds)  # a sequence is one symbol by now, so the two places differ
    order = np.argsort(-height, kind="stable")
    entered = np.searchsorted(-height[order], -np.arange(len(rounds)), side="left")  # queries above each round
    for number in range(len(rounds) - 1, -1, -1):
        each, active = rounds[number], order[: entered[number]]
        if not len(active):
            continue
        i, j = each.begin[at[active]], each.begin[to[active]]
        step = (each.symbols[i] == each.symbols[j]).astype(np.int64)
        if each.block:
            left = each.begin[at[active] + 1] - i
            step *= np.minimum(left, each.begin[to[active] + 1] - j)
        at[active], to[active] = i + step, j + step
    return at - one
