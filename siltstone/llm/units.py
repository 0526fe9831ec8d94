"""Token ids of texts by way of their separate words, each distinct word of a batch looked up once.

Both tokenizers here treat a text as units that never share a token. A process
keeps the ids of units that it has met in tables of bounded size, so that most
of the work on a text is to part it into words and to look these up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Ids from which a generation is full; a process remembers two, and keeps them for later tasks.
MOST_IDS = 1 << 22
# Bytes of text whose words are parted at a time; a process needs some ten times as much beside its tables.
PART_BYTES = 4 << 20


def spans_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[0], starts[0] + 1, ... of every span, one span after another."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - (ends - lengths), lengths)
    places += np.arange(len(places))
    return places


def sums_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of so many consecutive values each."""
    ends = np.cumsum(counts)
    totals = np.append(0, np.cumsum(values))
    return totals[ends] - totals[ends - counts]


def parts_by_size(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to PART_BYTES of text, one row at least."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > PART_BYTES:
            yield first, i
            first, held = i, 0
        held += int(size) + 1
    if len(sizes):
        yield first, len(sizes)


class Generation:
    """Flat ids of remembered units, and where each unit's ids lie."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)

    def end(self) -> int:
        return int(self.starts[len(self.codes)])

    def full(self, most: int) -> bool:
        return len(self.codes) > most or self.end() > MOST_IDS

    def add(self, units: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """New units with their ids one after another."""
        first, end = len(self.codes), self.end()
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + len(units) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[end : end + len(ids)] = ids
        self.starts[first + 1 : first + 1 + len(units)] = end + np.cumsum(lengths)
        self.codes.update(zip(units, range(first, first + len(units))))

    def ids_of(self, codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after another, and how many each has."""
        codes = np.array(codes, np.int64)
        starts = self.starts[codes]
        lengths = self.starts[codes + 1] - starts
        return self.ids[spans_of(starts, lengths)], lengths


class UnitTable:
    """Ids of words by their units. A full generation becomes the old one; units met again move to the new one.

    ``encode`` gives the ids of units that are new, ``units`` parts a word unless words are units.
    A generation is full with ``most`` units.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int, units: Callable[[str], list[str]] | None = None):
        self.units, self.encode_units, self.most = units, encode, most
        self.new, self.old = Generation(), Generation()

    def _learn(self, units: list[str]) -> None:
        known = [u for u in units if u in self.old.codes]
        self.new.add(known, *self.old.ids_of([self.old.codes[u] for u in known]))
        unmet = [u for u in units if u not in self.old.codes]
        found = self.encode_units(unmet)
        lengths = np.array([len(x) for x in found], np.int64)
        self.new.add(unmet, np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths)

    def _distinct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, and how many each has."""
        if self.new.full(self.most):
            self.new, self.old = Generation(), self.new
        parted = [self.units(w) for w in words] if self.units else None
        units = words if parted is None else list(chain.from_iterable(parted))
        codes = list(map(self.new.codes.get, units))
        if None in codes:
            missing = [i for i, c in enumerate(codes) if c is None]
            self._learn(list(dict.fromkeys(units[i] for i in missing)))
            for i in missing:
                codes[i] = self.new.codes[units[i]]
        ids, lengths = self.new.ids_of(codes)
        return ids, lengths if parted is None else sums_of(lengths, np.array([len(p) for p in parted], np.int64))

    def encode(self, words: pa.ListArray) -> list[np.ndarray]:
        """Ids of every text, given as its words."""
        counts = words.value_lengths().to_numpy()
        coded = words.flatten().dictionary_encode()
        ids, lengths = self._distinct(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy()
        each = lengths[at]
        flat = ids[spans_of((np.cumsum(lengths) - lengths)[at], each)]
        return np.split(flat, np.cumsum(sums_of(each, counts))[:-1]) if len(counts) else []


class ByteTable:
    """A byte string per id, to write out sequences of ids."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def write(self, ids: np.ndarray) -> bytes:
        return self.bytes[spans_of(self.starts[ids], self.lengths[ids])].tobytes()
