"""Whole Arrow batches of text as arrays: words, line and word hashes, windows.

Hashes are polynomials modulo 2**64 over prefix sums, so that the hash of any span
costs one subtraction whatever its length, followed by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Texts are worked on so many bytes at a time; a longer text is worked on alone.
CHUNK_BYTES = 1_000_000

#: Two independent multipliers, for hashes of 64 and of 128 bits.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[tuple[int, bool], np.ndarray] = {}


def power_table(base: int, n: int, inverse: bool = False) -> np.ndarray:
    table = _TABLES.get((base, inverse))
    if table is None or len(table) < n:
        size = max(n, CHUNK_BYTES + 1)
        table = powers(pow(base, -1, 2**64) if inverse else base, size)
        if size == CHUNK_BYTES + 1:
            _TABLES[base, inverse] = table
    return table


class Spans:
    """Hashes of spans ``[start, end)`` of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power_table(base, n + 1)[:n], out=self.sums[1:])
        self.inverse = power_table(base, n + 1, inverse=True)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """Hashes of spans of bytes in order, about ``CHUNK_BYTES`` of them at a time."""
    found, at = [np.zeros(0, np.uint64)], 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK_BYTES, side="right")))
        low, high = start[at], end[stop - 1]
        spans = Spans(data[low:high].astype(np.uint64) + np.uint64(1), base)
        found.append(spans(start[at:stop] - low, end[at:stop] - low))
        at = stop
    return np.concatenate(found)


def unrolled(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indices ``start[i] .. start[i] + count[i] - 1`` of all ``i`` in a row."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def unique_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each set of equal spans of bytes, and for every span its set's number.

    Sets come from hashes and are checked byte by byte.
    """
    _, first, number = np.unique(byte_hashes(data, start, end), return_index=True, return_inverse=True)
    length = end - start
    like = first[number]
    odd = np.flatnonzero(like != np.arange(len(like)))
    step = max(1, CHUNK_BYTES // 8)
    for at in range(0, len(odd), step):
        own = odd[at : at + step]
        size = length[own]
        if (size != length[like[own]]).any() or not np.array_equal(
            data[unrolled(start[own], size)], data[unrolled(start[like[own]], size)]
        ):
            raw = data.tobytes()
            numbers: dict[bytes, int] = {}
            for a, b in zip(start.tolist(), end.tolist(), strict=True):
                numbers.setdefault(raw[a:b], len(numbers))
            number = np.array([numbers[raw[a:b]] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
            return np.unique(number, return_index=True)[1], number
    return first, number


class Texts:
    """Some texts in one byte buffer; text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int = 0):
        self.data, self.bounds, self.first = data, bounds, first

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    def words(self) -> Words:
        return Words(self)


class Words:
    """The words of some texts: ``text`` of each, ``start`` and ``end`` in the buffer,
    and per text the numbers of its first word and the next text's first word."""

    def __init__(self, texts: Texts):
        space = SPACES[texts.data]
        before = np.ones(len(space), bool)
        before[1:] = space[:-1]
        starts = texts.bounds[:-1]
        before[starts[starts < len(space)]] = True
        self.start = np.flatnonzero(before & ~space)
        after = np.ones(len(space), bool)
        after[:-1] = space[1:]
        ends = texts.bounds[1:]
        after[ends[ends > 0] - 1] = True
        self.end = np.flatnonzero(after & ~space) + 1
        self.bounds = np.searchsorted(self.start, texts.bounds)
        self.count = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.texts = texts

    def hashes(self, base: int = BASES[0]) -> np.ndarray:
        return Spans(self.texts.data.astype(np.uint64) + np.uint64(1), base)(self.start, self.end)

    def runs(self, length: int) -> np.ndarray:
        """First words of the runs of ``length`` words that stay in one text."""
        n = len(self.start)
        if n < length:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.text[: n - length + 1] == self.text[length - 1 :])


def texts_of(column: pa.Array, chunk_bytes: int | None = None) -> Iterator[Texts]:
    """The column (null: empty) in parts of about ``chunk_bytes`` (``CHUNK_BYTES``), in order."""
    chunk_bytes = chunk_bytes or CHUNK_BYTES
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1
        stop = min(max(stop, at + 1), len(column))
        bounds = offsets[at : stop + 1]
        yield Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0], at)
        at = stop


def word_pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """One text's bytes in pieces of about ``CHUNK_BYTES``, cut only after white space: a
    longer word stays whole."""
    at = 0
    while at < len(data):
        stop = min(at + CHUNK_BYTES, len(data))
        while stop < len(data) and not SPACES[data[stop - 1]]:
            near = np.flatnonzero(SPACES[data[stop : stop + CHUNK_BYTES]])
            stop = stop + int(near[0]) + 1 if len(near) else min(stop + CHUNK_BYTES, len(data))
        yield data[at:stop]
        at = stop
