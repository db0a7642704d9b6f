"""Packing documents into sequences by the sum-of-squares rule.

Every task keeps an array of levels: how many open sequences are filled to each level.
A document goes to the level that makes the sum of the squared counts smallest, which
keeps few sequences open and their levels spread, so that later documents fit. A
document's parts of a whole sequence are cut off first.

No more than ``MOST_OPEN`` sequences stay open. Beyond, one sequence of the most crowded
level is given up to fill another of that level, cut if it does not fit as a whole; all
others keep their places, and the array goes on. When a task ends, what the open
sequences hold is laid end to end and cut into full ones; the last remainder is cut into
powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.textbatch import (
    CHUNK_BYTES,
    Texts,
    texts_of,
    unique_spans,
    unrolled,
    word_pieces,
)

CAPACITY, END = 4096, 2
#: Sequences that a task holds open at most: their ids are all it keeps in memory.
MOST_OPEN = 1024
#: Parts of words whose ids a Python worker remembers at most (about 200 bytes each).
REMEMBERED = 400_000
#: Bytes of text whose words are made unique together.
TOGETHER_BYTES = 8_000_000

# The tokenizer's own way to cut text into words, for ASCII and Latin-1 letters only
# (fixed values): contractions, runs of letters, single digits, runs of other characters.
# Words with any other character go through the tokenizer whole.
_CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")
_LATIN = 0xC3  # first byte of the letters from U+00C0 to U+00FF; second bytes:
_SIGNS = (0x97, 0xB7)  # no letters
_UPPER = range(0x80, 0x9F)
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)

_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
_CLASS[[*range(ord("0"), ord("9") + 1)]] = _DIGIT
_CLASS[ord(" ")] = _SPACE
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True


def _bytes(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


def _after(data: np.ndarray, n: int = 1) -> np.ndarray:
    """Each byte's ``n``-th next one; 0 at the end."""
    return np.append(data[n:], np.zeros(min(n, len(data)), data.dtype))


def plain_words(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words have nothing but visible ASCII and Latin-1 letters, and no ``<|``."""
    follows = np.append(False, words[:-1] == _LATIN)
    second = follows & (words & 0xC0 == 0x80) & ~np.isin(words, _SIGNS)
    first = (words == _LATIN) & np.append(second[1:], False)
    good = (_ASCII[words] & ~((words == ord("<")) & (_after(words) == ord("|")))) | first | second
    bad = np.append(0, np.cumsum(~good))
    return bad[end] == bad[start]


def lowered(words: np.ndarray) -> np.ndarray:
    upper = (words >= ord("A")) & (words <= ord("Z"))
    upper[1:] |= (words[:-1] == _LATIN) & np.isin(words[1:], [b for b in _UPPER if b not in _SIGNS])
    return words + upper * np.uint8(0x20)


def part_starts(words: np.ndarray) -> np.ndarray:
    """Where parts begin, in plain lower-case words with a space after each."""
    kind = _CLASS[words]
    before = np.append(np.uint8(_SPACE), kind[:-1])
    start = ((kind != before) | (kind == _DIGIT)) & (kind != _SPACE)
    quote = np.flatnonzero((words == ord("'")) & (before != _OTHER))
    for contraction in _CONTRACTIONS:
        n = len(contraction)
        own = quote[quote + n <= len(words)]
        for i in range(1, n):
            own = own[words[own + i] == contraction[i]]
        start[own + 1] = False
        start[own + n] = kind[own + n] != _SPACE
    return np.flatnonzero(start)


class Memory:
    """Values by key, of bounded number: what is not asked for in time is forgotten."""

    def __init__(self, most: int):
        self.half, self.new, self.old = max(1, most // 2), {}, {}

    def get_all(self, keys: list, make: Callable) -> list:
        found, new = [], self.new
        for key in keys:
            value = new.get(key)
            if value is None:
                value = self.old.get(key)
                if value is None:
                    value = make(key)
                if len(new) >= self.half:
                    self.new, self.old = {}, new
                    new = self.new
                new[key] = value
            found.append(value)
        return found


class Ids:
    """Rows of ids in one array: row ``i`` is ``flat[begin[i]:begin[i] + size[i]]``."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size, self.begin = flat, size, np.cumsum(size) - size

    @classmethod
    def of(cls, rows: list[bytes]) -> Ids:
        """From little-endian ids of four bytes each."""
        return cls(np.frombuffer(b"".join(rows), "<u4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4)

    def take(self, rows: np.ndarray) -> Ids:
        size = self.size[rows]
        return Ids(self.flat[unrolled(self.begin[rows], size)], size)

    def merged(self, bounds: np.ndarray) -> Ids:
        """The rows between two bounds as one row."""
        ends = np.append(0, np.cumsum(self.size))
        return Ids(self.flat, np.diff(ends[bounds]))


class WordIds:
    """Ids of texts by a tokenizer that drops white space.

    No token spans two words, or two parts of a word, so a text's ids are those of its
    parts in turn. The words of many texts are made unique, then the parts of these; only
    what is left is looked up or tokenised, and its ids are dealt out by their places.
    """

    def __init__(self, path: str, remembered: int | None = None):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {
            ord(c): letters.pre_tokenize_str(c)[0][0]
            for c in (*map(chr, range(0xC0, 0x100)),)
            if c not in "×÷"
        }
        self.parts = Memory(remembered or REMEMBERED)

    def _part(self, raw: bytes) -> bytes:
        letters = raw.decode() if raw.isascii() else raw.decode().translate(self.bytes_of)
        return _bytes([t.id for t in self.tokenizer.model.tokenize(letters)])

    def _plain(self, words: np.ndarray, size: np.ndarray) -> Ids:
        """The ids of plain words that stand in a row, each with a space after it."""
        words = lowered(words)
        start = part_starts(words)
        space = np.cumsum(size) - 1
        end = np.minimum(np.append(start[1:], len(words)), space[np.searchsorted(space, start)])
        first, number = unique_spans(words, start, end)
        raw = words.tobytes()
        keys = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        ids = Ids.of(self.parts.get_all(keys, self._part)).take(number)
        return ids.merged(np.append(0, np.searchsorted(start, space)))

    def of_texts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin."""
        words = texts.words()
        first, number = unique_spans(texts.data, words.start, words.end)
        size = words.end[first] - words.start[first] + 1
        # The unique words in a row, a space after each.
        some = np.append(texts.data, np.uint8(0x20))[unrolled(words.start[first], size)]
        ends = np.cumsum(size)
        some[ends - 1] = 0x20
        plain = plain_words(some, ends - size, ends - 1)
        found = self._plain(some[np.repeat(plain, size)], size[plain])
        others = [some[b - n : b - 1].tobytes().decode() for n, b in zip(size[~plain], ends[~plain], strict=True)]
        rest = Ids.of([_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)])
        unique = Ids(np.concatenate([found.flat, rest.flat]), np.concatenate([found.size, rest.size]))
        row = np.empty(len(first), np.int64)
        row[plain], row[~plain] = np.arange(plain.sum()), plain.sum() + np.arange(len(others))
        ids = unique.take(row[number])
        return ids.flat, np.append(0, np.cumsum(ids.size))[words.bounds]

    def __call__(self, raw: bytes) -> bytes:
        """The ids of one text in UTF-8, four bytes each; a long text is walked in pieces."""
        pieces = word_pieces(np.frombuffer(raw, np.uint8))
        return b"".join(self.of_texts(Texts(part, np.array([0, len(part)])))[0].tobytes() for part in pieces)


_IDS: dict[tuple[str, int | None], WordIds] = {}


def word_ids(path: str, remembered: int | None = None) -> WordIds:
    if (path, remembered) not in _IDS:
        _IDS[path, remembered] = WordIds(path, remembered)
    return _IDS[path, remembered]


class Packer:
    """Places documents, given as arrays of ids, and returns the pieces that are final.

    A piece is ``(document, start, ids, sequence, offset)``; sequences are numbered
    from ``first``.
    """

    def __init__(self, capacity: int = CAPACITY, first: int = 0, most_open: int = MOST_OPEN):
        self.capacity, self.next, self.most_open = capacity, first, most_open
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)
        self.n_open = 0

    def _number(self) -> int:
        self.next += 1
        return self.next - 1

    def _level(self, size: int) -> int:
        """The level at which a document of ``size`` adds least to the sum of squares."""
        top = self.capacity - size
        gain = 2 * self.counts[size : size + top + 1] + 1  # counts[capacity] stays 0
        gain[top] = 0  # a full sequence is not counted
        gain[1:] -= 2 * self.counts[1 : top + 1] - 1
        gain[1:][self.counts[1 : top + 1] == 0] = np.iinfo(np.int64).max
        # Of equal levels the fullest: it closes soonest.
        return int(top - np.argmin(gain[::-1]))

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        number, offset = self._number(), 0
        for document, start, ids in pieces:
            yield document, start, ids, number, offset
            offset += len(ids)

    def add(self, document, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._close([(document, start, ids[start : start + self.capacity])])
        size = len(ids) - whole
        if not size:
            return
        level = self._level(size)
        sequence = []
        if level:
            sequence = self._take(level)
        sequence.append((document, whole, ids[whole:]))
        if level + size == self.capacity:
            yield from self._close(sequence)
            return
        self._leave_open(level + size, sequence)
        if self.n_open > self.most_open:
            yield from self._relieve()

    def _leave_open(self, level: int, sequence: list[tuple]) -> None:
        self.open[level].append(sequence)
        self.counts[level] += 1
        self.n_open += 1

    def _take(self, level: int) -> list[tuple]:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _relieve(self) -> Iterator[tuple]:
        """One open sequence less: of the most crowded level one sequence is filled from
        another; where no level has two, the fullest from the emptiest."""
        level = given = int(self.counts.argmax())
        if self.counts[level] < 2:
            used = np.flatnonzero(self.counts)
            level, given = int(used[-1]), int(used[0])
        filled, other = self._take(level), self._take(given)
        room = min(self.capacity - level, given)
        left = room
        while left:
            document, start, ids = other.pop()
            cut = max(0, len(ids) - left)
            filled.append((document, start + cut, ids[cut:]))
            left -= len(ids) - cut
            if cut:
                other.append((document, start, ids[:cut]))
        if given > room:
            self._leave_open(given - room, other)
        if level + room < self.capacity:
            self._leave_open(level + room, filled)
        else:
            yield from self._close(filled)

    def flush(self) -> Iterator[tuple]:
        """Lays what the open sequences hold end to end and cuts it anew."""
        held = [p for level in sorted(self.open, reverse=True) for s in self.open[level] for p in s]
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0
        left = sum(len(ids) for *_, ids in held)
        sequence: list[tuple] = []
        room = self._room(left)
        for document, start, ids in held:
            while len(ids):
                part = ids[:room]
                sequence.append((document, start, part))
                start, ids, room, left = start + len(part), ids[len(part) :], room - len(part), left - len(part)
                if not room:
                    yield from self._close(sequence)
                    sequence, room = [], self._room(left)

    def _room(self, left: int) -> int:
        """The next sequence's length: full, or the largest power of two that is left."""
        return min(self.capacity, 1 << (left.bit_length() - 1)) if left else 0


def _pack(tokenizer: str, capacity: int, end: int, with_ids: bool, together: int | None, remembered: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer, remembered)
        packer = Packer(capacity, first=TaskContext.get().partitionId() << 36)
        final = np.array([end], "<u4")
        totals: dict[int, int] = {}  # row of an open document -> its tokens
        names: dict[int, int | None] = {}
        row = 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for texts in texts_of(batch.column(1), together or TOGETHER_BYTES):
                out = []
                alone = len(texts) == 1 and len(texts.data) > CHUNK_BYTES
                found, bounds = (None, None) if alone else encode.of_texts(texts)
                for i in range(len(texts)):
                    ids = np.frombuffer(encode(texts.raw(i)), "<u4") if alone else found[bounds[i] : bounds[i + 1]]
                    ids = np.concatenate([ids, final])
                    names[row], totals[row] = doc_ids[texts.first + i], len(ids)
                    out.extend(_row(p, names, totals) for p in packer.add(row, ids))
                    row += 1
                yield _batch(out, with_ids)
                held = {d for sequences in packer.open.values() for s in sequences for d, *_ in s}
                totals = {d: totals[d] for d in held}
                names = {d: names[d] for d in held}
        yield _batch((_row(p, names, totals) for p in packer.flush()), with_ids)

    return run


def _row(piece: tuple, names: dict, totals: dict) -> tuple:
    document, start, ids, sequence, offset = piece
    return names[document], start, len(ids), zlib.crc32(ids), totals[document], sequence, offset, ids


SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint"
)
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _batch(rows: Iterable[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * (len(_NAMES) + 1)
    out = [pa.array(c, pa.int64()) for c in columns[:-1]]
    if not with_ids:
        return pa.RecordBatch.from_arrays(out, _NAMES)
    ids = pa.array([x.view("<i4") for x in columns[-1]], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([*out, ids], [*_NAMES, "ids"])


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = END,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = True,
    together: int | None = None,
    remembered: int | None = None,
) -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, unless they are not wanted, ``ids``.

    A document's ids are its text's by the tokenizer file, then ``end``; a null or empty
    text is ``end`` alone. Each of its ids lies in exactly one piece. ``sequence_id`` is
    unique over all tasks; ``offset`` runs from 0 without a gap. Repeated rows are packed
    each. An empty table gives no pieces. Tasks pack apart, so a task that is run again
    gives the same pieces of the same rows.

    ``together`` and ``remembered`` bound a worker's memory (``TOGETHER_BYTES`` and
    ``REMEMBERED`` unless given) and change no result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = f"{SCHEMA}, ids array<int>" if with_ids else SCHEMA
    return rows.mapInArrow(_pack(tokenizer, capacity, end, with_ids, together, remembered), schema)
