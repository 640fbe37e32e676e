"""Locally consistent anchors: which positions stand for which windows of a sequence.

A window of ``width`` symbols is represented by its anchor, the gram of ``gram`` symbols inside it
with the smallest hash (the leftmost of equal ones). Two equal windows have the same anchor at the
same place, so windows only have to be compared where an anchor's gram occurs again. Neighbouring
windows mostly share their anchor; such a run is one entry here, about two for every
``width - gram`` symbols.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_PLACE_BITS = np.uint64(24)
_PLACE_MASK = np.uint64((1 << 24) - 1)
CHUNK = 1 << 20  # windows handled at once


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(31)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(29)
    return hashes


class _Rolling:
    """Polynomial hashes of all grams of a block, modulo 2**64, mixed to spread their order."""

    def __init__(self) -> None:
        self.size, self.up, self.down = 0, None, None

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 1 << 16)
            self.up = _powers(int(_BASE), self.size)
            self.down = _powers(_inverse(int(_BASE)), self.size)

    def grams(self, symbols: np.ndarray, gram: int) -> np.ndarray:
        self._grow(len(symbols))
        sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self.up[: len(symbols)], out=sums[1:])
        return _mixed((sums[gram:] - sums[:-gram]) * self.down[: len(symbols) - gram + 1])

    def stretches(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the stretches ``[start, end)``, of whatever length."""
        self._grow(len(symbols))
        sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self.up[: len(symbols)], out=sums[1:])
        lengths = (end - start).astype(np.uint64)
        return _mixed((sums[end] - sums[start]) * self.down[start] + lengths * _BASE)


_rolling = _Rolling()


@dataclass(frozen=True)
class Runs:
    """Runs of windows that share an anchor: its hash, its place, first and last window start."""

    key: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(symbols: np.ndarray, width: int, gram: int) -> Runs:
    """All windows of ``width`` symbols as runs; ``symbols`` are 64-bit codes of bytes or words.

    Long sequences are taken in blocks; a run that is cut between two blocks becomes two.
    """
    parts = []
    for at in range(0, len(symbols) - width + 1, CHUNK):
        block = symbols[at : at + CHUNK + width - 1]
        hashes = _rolling.grams(block, gram)
        packed = (hashes & ~_PLACE_MASK) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_sliding_minimum(packed, width - gram + 1) & _PLACE_MASK).astype(np.int64)
        change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        first = np.concatenate(([0], change))
        last = np.concatenate((change, [len(anchor)])) - 1
        place = anchor[first]
        parts.append((hashes[place], place + at, first + at, last + at))
    if not parts:
        empty = np.zeros(0, np.int64)
        return Runs(empty.astype(np.uint64), empty, empty, empty)
    return Runs(*(np.concatenate(columns) for columns in zip(*parts)))


def stretches(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of a sequence."""
    return _rolling.stretches(symbols, start, end)


def within(found: Runs, owner: np.ndarray, width: int) -> Runs:
    """Runs over sequences laid end to end, cut to the windows inside one of them.

    ``owner`` numbers the sequence of each symbol. An anchor lies in one sequence, so the whole
    windows of a run belong to that sequence alone and stand side by side.
    """
    whole = np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])
    low, high = np.searchsorted(whole, found.first), np.searchsorted(whole, found.last, side="right") - 1
    kept = high >= low
    return Runs(found.key[kept], found.anchor[kept], whole[low[kept]], whole[high[kept]])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open spans; touching ones join."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
