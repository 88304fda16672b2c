"""Words, lines and rolling hashes of Arrow string columns as numpy arrays.

Everything works on the UTF-8 bytes of a bounded run of rows at a time (``slices``), so memory does
not depend on the size of an Arrow batch; only a single text longer than the limit is taken alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
CAST_ROWS = 1024

#: The white space of the word pattern [^\x20\x09-\x0D]+.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True
#: A byte that begins a code point.
IS_START = (np.arange(256) & 0xC0) != 0x80
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_rng = np.random.default_rng(20240607)
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
FOLDED_VALUES = BYTE_VALUES[FOLD]
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
STEP = 1 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one to one)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Powers:
    """base ** i modulo 2 ** 64 for i below ``n``, as products from two short tables, so a worker need not keep long ones."""

    def __init__(self, base: int, n: int):
        self.n = n
        self.low = self._first(base, STEP)
        self.high = self._first(pow(base, STEP, 2**64), max(1, -(-n // STEP)))

    @staticmethod
    def _first(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out, out=out)

    def all(self) -> np.ndarray:
        return (self.high[:, None] * self.low).ravel()[: self.n]

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.high[places // STEP] * self.low[places % STEP]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


class Rolling:
    """Hashes of spans of one sequence of 64-bit values, equal for equal content (up to 2 ** -64)."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        n = len(values)
        self.base = base
        self.sums = np.zeros(n + 1, np.uint64)
        terms = Powers(base, n).all()
        terms *= values
        np.cumsum(terms, out=self.sums[1:])
        self.back = Powers(inverse(base), n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.back.at(starts)
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(BASES[1]))


class Slice:
    """Some consecutive texts: their bytes joined, and where each begins and ends."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, first_row: int):
        self.data, self.begins, self.first_row = data, begins, first_row
        self.rows = len(begins) - 1

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Row of the slice that holds each byte position."""
        return np.searchsorted(self.begins[1:], positions, side="right")

    def per_row(self, positions: np.ndarray) -> np.ndarray:
        """Count of (sorted) byte positions in each row."""
        return np.diff(np.searchsorted(positions, self.begins))

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal runs of true bytes that stay within one text."""
        n = len(inside)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none
        edge = np.zeros(n + 1, bool)
        edge[self.begins] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~IS_SEPARATOR[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines split at a line feed; an empty text is one empty line."""
        feeds = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate([self.begins[:-1], feeds + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.begins[1:], feeds]), kind="stable")
        return starts, ends

    def line_owner(self, starts: np.ndarray) -> np.ndarray:
        """Row of each line; ``starts`` holds, per row, its own begin and one place per line feed."""
        counts = 1 + self.per_row(np.flatnonzero(self.data == 10))
        return np.repeat(np.arange(self.rows), counts)

    def rolling(self, fold: bool, base: int = BASES[0]) -> Rolling:
        return Rolling((FOLDED_VALUES if fold else BYTE_VALUES)[self.data], base)

    def code_points(self) -> np.ndarray:
        """Number of code points before each byte position."""
        out = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(IS_START[self.data], out=out[1:])
        return out


def whole(column: pa.Array) -> Slice:
    """All texts of an array that is short already; null counts as empty."""
    return next(slices(column, 1 << 62, max(len(column), 1)))


def slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[Slice]:
    """The texts of a string column in order; null counts as empty."""
    step = min(rows, max(CAST_ROWS, len(column) if limit > 1 << 40 else 0))
    for first in range(0, len(column), step):
        yield from _slices(column.slice(first, step), first, limit)


def _slices(column: pa.Array, first: int, limit: int) -> Iterator[Slice]:
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        stop = min(max(stop, at + 1), len(column))
        yield Slice(data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at], first + at)
        at = stop
