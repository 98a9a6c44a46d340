"""An FM-index over words: suffix order, wavelet matrix, sampled positions.

The text of an index is the words of many documents, one after another, each
document closed by an end mark of its own.  Counting goes backwards over a
phrase: a word narrows an interval of the suffix order by two ranks in the
wavelet matrix of the transformed text.  A row of that interval is located by
stepping backwards until a sampled place is met; every document's first word is
sampled, so no step leaves its document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Every so many words of a document are sampled.
SAMPLED = 32


def suffix_order(text: np.ndarray, top: int) -> np.ndarray:
    """Order of the suffixes of ``text``, whose symbols are 0 to ``top``; the last symbol occurs only there.

    The first few symbols are packed in one number and sorted; then suffixes
    that are still alike are sorted by the rank of what follows, twice as far
    in each round.
    """
    n, bits = len(text), max(1, int(top).bit_length())
    reach = max(1, 62 // bits)
    key = text.astype(np.int64)
    for j in range(1, reach):
        key <<= bits
        key[:max(0, n - j)] |= text[j:]
    order = np.argsort(key, kind="stable")
    key = key[order]
    opens = np.ones(n + 1, bool)  # does a group of like suffixes begin here?
    opens[1:n] = key[1:] != key[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0
    first = np.flatnonzero(opens[:n])
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    while True:
        places = np.flatnonzero(~(opens[:n] & opens[1:]))
        if not len(places):
            return order
        who = order[places]
        key = rank[who] * (n + 1) + rank[np.minimum(who + reach, n)]
        by = np.argsort(key, kind="stable")
        key, who = key[by], who[by]
        order[places] = who
        fresh = np.ones(len(places), bool)
        fresh[1:] = key[1:] != key[:-1]
        opens[places] = fresh
        first = np.flatnonzero(fresh)
        rank[who] = np.repeat(places[first], np.diff(np.append(first, len(places))))
        reach *= 2


class Bits:
    """A row of bits with ranks."""

    def __init__(self, n: int, packed: np.ndarray) -> None:
        self.n, self.cells = n, packed
        self.before = np.zeros(len(packed) + 1, np.int64)
        np.cumsum(np.bitwise_count(packed), out=self.before[1:], dtype=np.int64)

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        raw = np.packbits(bits, bitorder="little")
        return np.frombuffer(raw.tobytes() + bytes(-len(raw) % 8 + 8), "<u8")

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        cell = at >> 6
        return self.before[cell] + np.bitwise_count(self.cells[cell] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.cells[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


@dataclass
class Index:
    """An index of ``n`` words and end marks.

    Word k of ``words`` has symbol k + 1, all end marks have symbol 0.
    ``begins[s]`` counts the symbols below s.
    """

    n: int
    words: pa.Array
    begins: np.ndarray
    levels: list[Bits]
    marks: Bits
    samples: np.ndarray

    @classmethod
    def build(cls, text: np.ndarray, offsets: np.ndarray, words: pa.Array) -> "Index":
        """``text`` has the words' symbols from 1 on; document d takes text[offsets[d]:offsets[d + 1] - 1] and a 0."""
        n, ends = len(text), offsets[1:] - 1
        distinct = text.astype(np.int64) + len(ends) - 1
        distinct[ends] = np.arange(len(ends))  # an end mark is unlike any other
        order = suffix_order(distinct, len(ends) + len(words) - 1)
        moved = text[order - 1]  # the symbol before each suffix; the last one, an end mark, before the first
        levels, bits = cls._levels(moved, len(words))
        at = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
        sampled = (at % SAMPLED == 0)[order]
        begins = np.zeros(len(words) + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=len(words) + 1), out=begins[1:])
        return cls(n, words, begins, levels, Bits(n, Bits.pack(sampled)), order[sampled].astype("<i4"))

    @staticmethod
    def _levels(symbols: np.ndarray, top: int) -> tuple[list[Bits], int]:
        levels, count = [], max(1, int(top).bit_length())
        for shift in range(count - 1, -1, -1):
            bit = (symbols >> shift) & 1 == 1
            levels.append(Bits(len(symbols), Bits.pack(bit)))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))
        return levels, count

    def symbols(self, words: pa.Array) -> np.ndarray:
        """The words' symbols, 0 for those that the index does not have."""
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def __post_init__(self) -> None:
        self._zeros = [level.n - int(level.before[-1]) for level in self.levels]

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place below the wavelet matrix that ``at`` comes to on the way of ``symbol``."""
        for k, level in enumerate(self.levels):
            one = ((symbol >> (len(self.levels) - 1 - k)) & 1).astype(bool)
            ones = level.ones(at)
            at = np.where(one, self._zeros[k] + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the phrases that have ``symbol`` before those of [low, high)."""
        zero = self._rank(symbol, np.zeros_like(low))
        begin = self.begins[symbol] - zero
        return begin + self._rank(symbol, low), begin + self._rank(symbol, high)

    def count(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of phrases of one length, one a row, as symbols of this index; 0 stands for no word of it."""
        live = np.flatnonzero((phrases > 0).all(axis=1))
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        high[live] = self.n
        for k in range(phrases.shape[1] - 1, -1, -1):
            low[live], high[live] = self.step(phrases[live, k], low[live], high[live])
            live = live[low[live] < high[live]]
        found = np.zeros(len(phrases), bool)
        found[live] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def _back(self, row: np.ndarray) -> np.ndarray:
        """The suffix that begins one word earlier."""
        at, symbol = row, np.zeros(len(row), np.int64)
        for k, level in enumerate(self.levels):
            one = level.get(at)
            ones = level.ones(at)
            at = np.where(one, self._zeros[k] + ones, at - ones)
            symbol = symbol << 1 | one
        return self.begins[symbol] + at - self._rank(symbol, np.zeros_like(at))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes of these rows begin."""
        place, row, open_ = np.zeros(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        for walked in range(SAMPLED):
            hit = self.marks.get(row)
            place[open_[hit]] = self.samples[self.marks.ones(row[hit])] + walked
            open_, row = open_[~hit], row[~hit]
            if not len(open_):
                break
            row = self._back(row)
        return place

    def dump(self) -> dict:
        """The index as plain columns."""
        return {"n": self.n, "words": self.words, "counts": np.diff(self.begins).astype("<i4").tobytes(),
                "levels": [level.cells.tobytes() for level in self.levels], "marks": self.marks.cells.tobytes(),
                "samples": self.samples.tobytes()}

    @classmethod
    def load(cls, n: int, words: pa.Array, counts: bytes, levels: list[bytes], marks: bytes, samples: bytes) -> "Index":
        cells = [np.frombuffer(x, "<u8") for x in levels]
        begins = np.concatenate(([0], np.cumsum(np.frombuffer(counts, "<i4"), dtype=np.int64)))
        return cls(n, words, begins, [Bits(n, c) for c in cells], Bits(n, np.frombuffer(marks, "<u8")), np.frombuffer(samples, "<i4"))
