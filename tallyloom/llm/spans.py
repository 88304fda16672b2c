"""A bounded dictionary from spans of text to runs of ids, looked up for all spans of a slice at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tallyloom.llm.textbytes import BASES, Slice

MAX_SPANS = 1 << 20

Encode = Callable[[Slice, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Growing:
    """An array with room at its end, so that what is added costs by its own length."""

    def __init__(self, kind: type):
        self.room, self.n = np.zeros(1 << 10, kind), 0

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.room):
            wider = np.zeros(max(n, 2 * len(self.room)), self.room.dtype)
            wider[: self.n] = self.data
            self.room = wider
        self.room[self.n : n] = values
        self.n = n

    @property
    def data(self) -> np.ndarray:
        return self.room[: self.n]


class Run:
    """Sorted hashes and the entry of each."""

    def __init__(self):
        self.keys, self.entries = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Entries of the keys, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.entries[place], np.int32(-1))

    def add(self, keys: np.ndarray, entries: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        self.keys, self.entries = np.insert(self.keys, at, keys), np.insert(self.entries, at, entries)


class SpanIds:
    """Remembers the ids of spans it has met. A span is found by one 64-bit hash and confirmed by another.

    ``encode`` gets a slice and the places of new spans, and gives all ids in turn and how many each span has. New
    entries go to a short run, which joins the long one at a quarter of its length. Beyond ``MAX_SPANS`` entries the
    dictionary starts anew; that changes time, not results.
    """

    def __init__(self, encode: Encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.long, self.short = Run(), Run()
        self.checks, self.offsets, self.counts = Growing(np.uint64), Growing(np.int64), Growing(np.int64)
        self.ids = Growing(np.int32)

    def _remember(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Entries of new spans, whose keys are sorted."""
        entries = np.arange(self.checks.n, self.checks.n + len(keys), dtype=np.int32)
        self.offsets.add(self.ids.n + np.concatenate([[0], np.cumsum(counts)])[:-1])
        self.checks.add(checks)
        self.counts.add(counts)
        self.ids.add(ids)
        self.short.add(keys, entries)
        if 4 * len(self.short.keys) >= len(self.long.keys):
            self.long.add(self.short.keys, self.short.entries)
            self.short = Run()
        return entries

    def lookup(self, part: Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans in turn, and the number of ids of each span."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys = part.rolling(fold=False, base=BASES[0]).spans(starts, ends)
        checks = part.rolling(fold=False, base=BASES[1]).spans(starts, ends)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        found = self.long.find(distinct)
        rest = np.flatnonzero(found < 0)
        found[rest] = self.short.find(distinct[rest])
        rest = rest[found[rest] < 0]
        if len(rest):
            new = first[rest]
            ids, counts = self.encode(part, starts[new], ends[new])
            if self.checks.n + len(new) > MAX_SPANS and self.checks.n:
                self.clear()
                return self.lookup(part, starts, ends)
            found[rest] = self._remember(distinct[rest], checks[new], ids, counts)
        entry = found[inverse]
        counts = self.counts.data[entry]
        offsets = self.offsets.data[entry]
        wrong = np.flatnonzero(self.checks.data[entry] != checks)
        if len(wrong):  # another span of the same hash is known: these few are encoded by themselves
            ids, own = self.encode(part, starts[wrong], ends[wrong])
            counts[wrong] = own
            offsets[wrong] = self.ids.n + np.concatenate([[0], np.cumsum(own)])[:-1]
            source = np.concatenate([self.ids.data, ids])
        else:
            source = self.ids.data
        shift = offsets - np.concatenate([[0], np.cumsum(counts)])[:-1]
        return source[np.repeat(shift, counts) + np.arange(counts.sum())], counts


def span_bytes(part: Slice, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data = part.data.tobytes()
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
