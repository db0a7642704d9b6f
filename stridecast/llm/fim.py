"""Fill-in-the-middle texts, assembled by a secondary sort.

A text is cut into prefix, middle and suffix between its units. Its parts leave the first
task as pieces of whole units, keyed by document and place in the output;
``repartitionAndSortWithinPartitions`` brings a document's pieces together in that order,
and they stream through one digest, or into one text. To restore the text, the sections
are read from that stream by its markers, keyed by their place in the original and sorted
again. The second sort has the partitioner of the first, so nothing is shuffled for it;
both sorts spill to disk.

A document's key is its row, not its id, so that repeated and null ids stay apart and no
task gets more than its share of the documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.llm.tables import shuffle_partitions

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKER = re.compile(b"<[PSM]>")
#: Sections by their markers, in the order of the original text.
SECTIONS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many stay plain; of 100 others so many are spm.
PLAIN_PERCENT, SPM_PERCENT = 10, 20

#: Bytes of a piece, and bytes of a text that are looked at together.
PIECE_BYTES = 1 << 16
LOOK_BYTES = 1 << 20
#: Bytes of text that are dealt to one task of the sort, on average at most.
TASK_BYTES = 1 << 26

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class Header(NamedTuple):
    doc_id: int | None
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None


def _starts(raw: bytes, begin: int, end: int) -> np.ndarray:
    """Where units begin in ``raw[begin:end]``: letters not after letters, other code points."""
    data = np.frombuffer(raw, np.uint8, end - begin, begin)
    letter = _LETTER[data]
    start = data & 0xC0 != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    if begin and len(start):
        start[0] &= not (letter[0] and _LETTER[raw[begin - 1]])
    return np.flatnonzero(start) + begin


def _ranges(begin: int, end: int) -> Iterator[tuple[int, int]]:
    for at in range(begin, end, LOOK_BYTES):
        yield at, min(at + LOOK_BYTES, end)


def count_units(raw: bytes) -> int:
    return sum(len(_starts(raw, a, b)) for a, b in _ranges(0, len(raw)))


def unit_offsets(raw: bytes, units: Iterable[int]) -> list[int]:
    """The byte at which each of the ``units`` (ascending) begins; the end for the one after the last."""
    found, seen, left = [], 0, list(units)
    for a, b in _ranges(0, len(raw)):
        starts = _starts(raw, a, b)
        while left and left[0] < seen + len(starts):
            found.append(int(starts[left.pop(0) - seen]))
        seen += len(starts)
        if not left:
            break
    return found + [len(raw)] * len(left)


def code_points(raw: bytes, begin: int, end: int) -> int:
    return sum(
        int(np.count_nonzero(np.frombuffer(raw, np.uint8, b - a, a) & 0xC0 != 0x80)) for a, b in _ranges(begin, end)
    )


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from the id; a null id counts as an empty one."""
    seed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(seed[i : i + 8], 16) for i in range(0, 32, 8)]


def _chunks(raw: bytes, begin: int, end: int) -> Iterator[bytes]:
    """``raw[begin:end]`` in pieces of whole units; only a longer unit is cut, between code points."""
    while end - begin > PIECE_BYTES:
        starts = _starts(raw, begin, begin + PIECE_BYTES)
        stop = int(starts[-1]) if len(starts) and starts[-1] > begin else begin + PIECE_BYTES
        yield raw[begin:stop]
        begin = stop
    yield raw[begin:end]


def pieces_of(doc_id: int | None, raw: bytes) -> tuple[Header, Iterator[bytes]]:
    """What is known of a text in UTF-8, and its pieces in the order of the output."""
    n = count_units(raw)
    h1, h2, h3, h4 = draws(doc_id)
    if not raw or h3 % 100 >= 100 - PLAIN_PERCENT or MARKER.search(raw):
        return Header(doc_id, n, PLAIN, None, None), _chunks(raw, 0, len(raw))
    a, b = unit_offsets(raw, sorted((h1 % (n + 1), h2 % (n + 1))))
    form = SPM if h4 % 100 < SPM_PERCENT else PSM
    parts = [(PREFIX, 0, a), (SUFFIX, b, len(raw)), (MIDDLE, a, b)]
    if form == SPM:
        parts[0], parts[1] = parts[1], parts[0]

    def output() -> Iterator[bytes]:
        for marker, begin, end in parts:
            for chunk in _chunks(raw, begin, end):
                yield marker + chunk
                marker = b""

    return Header(doc_id, n, form, code_points(raw, 0, a), code_points(raw, a, b)), output()


def sections(form: str, stream: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """The parts of an output stream, each with its section's place in the original text."""
    if form == PLAIN:
        yield from ((0, part) for part in stream)
        return
    place, kept = 0, b""
    for part in stream:
        part = kept + part
        at = 0
        for found in MARKER.finditer(part):
            yield place, part[at : found.start()]
            place, at = SECTIONS[found[0]], found.end()
        # What may begin a marker waits for the next part.
        stop = max(at, len(part) - len(PREFIX) + 1)
        yield place, part[at:stop]
        kept = part[stop:]
    yield place, kept


def by_document(key: tuple) -> int:
    """The partition of a key, by its document alone."""
    return (key[0] * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 32


def sorted_pieces(docs: DataFrame, text: str, doc_id: str) -> RDD:
    """``((row, place), (header of the first piece, bytes))`` in the order of the outputs.

    The texts are measured first: a sort of an RDD is not planned anew while it runs, so
    its number of tasks has to follow from the bytes.
    """
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    tasks = max(shuffle_partitions(docs.sparkSession), -(-size // TASK_BYTES))

    def emit(rows: Iterator) -> Iterator[tuple]:
        for row, own, raw in rows:
            header, pieces = pieces_of(own, bytes(raw))
            for place, piece in enumerate(pieces):
                yield (row, place), (header if place == 0 else None, piece)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("own"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("raw"),
    )
    return rows.rdd.mapPartitions(emit).repartitionAndSortWithinPartitions(tasks, by_document)


def _documents(pairs: Iterator[tuple]) -> Iterator[tuple[int, Header, Iterator[bytes]]]:
    """Row, header and the stream of pieces of one document after the other."""
    for row, own in groupby(pairs, lambda pair: pair[0][0]):
        _, (header, first) = next(own)

        def stream(first=first, own=own) -> Iterator[bytes]:
            yield first
            for _, (_, piece) in own:
                yield piece

        yield row, header, stream()


_HEADER = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"


def transformed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, text``.

    ``text`` is the output: the text itself if ``form`` is ``plain``, else prefix, suffix
    and middle behind ``<P>``, ``<S>`` and ``<M>``, in the order P S M (``psm``) or S P M
    (``spm``). ``n`` counts the units (runs of ASCII letters, other code points);
    ``prefix_chars`` and ``middle_chars`` count code points and are null for ``plain``.
    A null text counts as empty and is plain, as is a text that holds a marker. The cuts
    and forms follow from ``doc_id`` (null: as an empty id) and ``n`` alone, so repeated
    rows give equal rows. Each row gives one row; an empty table gives none. Other columns
    are not looked at.
    """

    def assemble(pairs: Iterator[tuple]) -> Iterator[tuple]:
        for _, header, stream in _documents(pairs):
            yield (*header, b"".join(stream).decode())

    found = sorted_pieces(docs, text, doc_id).mapPartitions(assemble)
    return docs.sparkSession.createDataFrame(found, f"{_HEADER}, text string")


def restored(form: Column, output: Column) -> Column:
    """The original text from an output and its form, as an expression."""
    parts = {
        PSM: F.regexp_replace(output, "(?s)^<P>(.*)<S>(.*)<M>(.*)$", "$1$3$2"),
        SPM: F.regexp_replace(output, "(?s)^<S>(.*)<P>(.*)<M>(.*)$", "$2$3$1"),
    }
    return F.when(form == PSM, parts[PSM]).when(form == SPM, parts[SPM]).otherwise(output)


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``transformed`` without the texts, but with ``output_sha256`` and ``restored_sha256``
    (lowercase hex, UTF-8), the digest of the text rebuilt from output and form.

    Neither text is ever held whole after the first task: pieces stream through the
    digests in the order of the output, then in that of the original.
    """

    def assemble(pairs: Iterator[tuple]) -> Iterator[tuple]:
        for row, header, stream in _documents(pairs):
            digest = hashlib.sha256()

            def told(stream=stream, digest=digest) -> Iterator[bytes]:
                for piece in stream:
                    digest.update(piece)
                    yield piece

            for i, (place, part) in enumerate(sections(header.form, told())):
                if part:
                    yield (row, place, i), part
            yield (row, -1, 0), (*header, digest.hexdigest())

    def rebuild(pairs: Iterator[tuple]) -> Iterator[tuple]:
        for _, own in groupby(pairs, lambda pair: pair[0][0]):
            _, found = next(own)
            digest = hashlib.sha256()
            for _, part in own:
                digest.update(part)
            yield (*found, digest.hexdigest())

    outputs = sorted_pieces(docs, text, doc_id).mapPartitions(assemble, preservesPartitioning=True)
    originals = outputs.repartitionAndSortWithinPartitions(outputs.getNumPartitions(), by_document)
    return docs.sparkSession.createDataFrame(
        originals.mapPartitions(rebuild), f"{_HEADER}, output_sha256 string, restored_sha256 string"
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS seed
  FROM documents
), h AS (
  SELECT *, len(units) AS n,
         ('0x' || seed[1:8])::BIGINT AS h1, ('0x' || seed[9:16])::BIGINT AS h2,
         ('0x' || seed[17:24])::BIGINT AS h3, ('0x' || seed[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
         array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
