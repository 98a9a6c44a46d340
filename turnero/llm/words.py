"""Words of Arrow text columns, cut with array operations instead of a loop over words.

A word is a longest run of digits, letters A-Z and a-z and characters beyond
ASCII, with A-Z lower-cased.  In UTF-8 these are exactly the runs of the bytes
below, so nothing has to be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut at a time; a longer text is cut between words.
WINDOW = 1 << 21

#: Each byte's lower-cased form; 0 for bytes that stand between words.
FORM = np.arange(256, dtype=np.uint8)
FORM[:0x30] = FORM[0x3A:0x41] = FORM[0x5B:0x61] = FORM[0x7B:0x80] = 0
FORM[0x41:0x5B] = np.arange(0x61, 0x7B)

#: Odd multipliers of the words' hashes; a later one is taken if two words collide under an earlier one.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


class Collision(Exception):
    """Two words of a window have one hash."""


@dataclass
class Window:
    """Words of some whole texts, or of a part of one.

    ``inverse`` has a place in ``distinct`` for each word; ``parts`` lists
    (text's place in the batch, first word, end) in order.
    """

    distinct: list[bytes]
    inverse: np.ndarray
    parts: list[tuple[int, int, int]]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (text, from, to) in bytes, about a window together; a long text is cut where no word is cut."""
    held: list[tuple[int, int, int]] = []
    size = 0
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        while b - a > WINDOW:
            cut = a + WINDOW
            step = 1 << 12
            while cut < b:
                gaps = np.flatnonzero(FORM[data[cut:min(b, cut + step)]] == 0)
                if len(gaps):
                    cut += int(gaps[0])
                    break
                cut, step = min(b, cut + step), step * 2
            if held:
                yield held
            yield [(i, a, cut)]
            held, size, a = [], 0, cut
        held.append((i, a, b))
        size += b - a
        if size >= WINDOW:
            yield held
            held, size = [], 0
    if held:
        yield held


def same_bytes(data: np.ndarray, one: np.ndarray, two: np.ndarray, lengths: np.ndarray, at_once: int = 1 << 17) -> bool:
    """Are data[one:one + length] and data[two:two + length] equal throughout?"""
    for i in range(0, len(lengths), at_once):
        n = lengths[i:i + at_once]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if not np.array_equal(data[np.repeat(one[i:i + at_once], n) + step], data[np.repeat(two[i:i + at_once], n) + step]):
            return False
    return True


class Cutter:
    """Cuts texts into words; ``windows`` yields them some megabytes of text at a time."""

    def __init__(self) -> None:
        self.powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _powers(self, multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if multiplier not in self.powers or len(self.powers[multiplier][0]) <= n:
            n = max(n, WINDOW + (1 << 16))
            up, down = np.full(n + 1, multiplier, np.uint64), np.full(n + 1, pow(multiplier, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.powers[multiplier] = np.cumprod(up), np.cumprod(down)
        return self.powers[multiplier]

    def _window(self, data: np.ndarray, pieces: list[tuple[int, int, int]], multiplier: int) -> Window:
        a, b = pieces[0][1], pieces[-1][2]
        form = FORM[data[a:b]]
        inside = form != 0
        breaks = np.array([p[1] for p in pieces], np.int64) - a
        breaks = breaks[breaks < b - a]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[breaks] = inside[breaks]
        closes[:-1] &= ~inside[1:]
        closes[breaks[breaks > 0] - 1] = inside[breaks[breaks > 0] - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        up, down = self._powers(multiplier, b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(form * up[:b - a], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        lengths = ends - starts
        if not np.array_equal(lengths, lengths[first][inverse]) or not same_bytes(form, starts, starts[first][inverse], lengths):
            raise Collision
        whole = form.tobytes()
        distinct = [whole[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())]
        at = np.searchsorted(starts, [p[1] - a for p in pieces] + [b - a])
        return Window(distinct, inverse.astype(np.int32), [(p[0], int(i), int(j)) for p, i, j in zip(pieces, at[:-1], at[1:])])

    def windows(self, texts: pa.Array) -> Iterator[Window]:
        data, offsets = bytes_of(texts)
        for pieces in _pieces(data, offsets):
            for multiplier in MULTIPLIERS:
                try:
                    yield self._window(data, pieces, multiplier)
                    break
                except Collision:
                    continue
            else:
                raise ValueError("words collide under every multiplier")
