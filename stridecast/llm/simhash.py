"""SimHash near-duplicates by segment popcounts and a grid range join.

A fingerprint of 64 bits is mapped to the bit counts of its 2-bit segments. The
Manhattan distance of two such vectors is at most the Hamming distance of the
fingerprints, so links at 4 or fewer bits lie within distance 4. Of the two halves of
the vector, 16 coordinates each, one is then within distance 2, and two such points
have a common grid point within distance 1 of both: every fingerprint is entered, for
each half, in its own grid cell and in the cells one step away, at most 66 in all, and
every link shares a cell. What shares a cell is verified by the exact Hamming distance.

Equal fingerprints are one point. A crowded cell gives a spanning forest of its links
instead of all of them, which leaves the components as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.llm.components import components
from stridecast.llm.tables import PlacedRows, checked_broadcast, shuffle_partitions, stage
from stridecast.llm.textbatch import Texts, texts_of
from stridecast.operators.lookup import attach

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Runs of this many fingerprints in a cell are compared pair by pair, with all links given.
SMALL_RUN = 32
#: A task compares at most so many fingerprints of one cell with each other at a time.
BLOCK = 4096
BROADCAST_CELLS = 100_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _bits_over_half(h: np.ndarray) -> int:
    if not len(h):
        return 0
    ones = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints_of(texts: Texts, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprints of some texts as unsigned integers."""
    texts = Texts(_LOWER[texts.data], texts.bounds, texts.first)
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i in range(len(texts)):
        words = texts.raw(i).split()  # at space and U+0009 to U+000D
        if not words:
            continue
        joined = b" ".join(words)  # a shingle is a slice of it
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.append(0, ends[:-1])
        last = min(shingle, len(words)) - 1
        spans = zip(starts[: len(words) - last].tolist(), (ends[last:] - 1).tolist(), strict=True)
        out[i] = _bits_over_half(np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64))
    return out


def fingerprints(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """The columns ``key`` and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints_of(t) for t in texts_of(batch.column(len(key)))]
            fp = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(fp)], [*key, "fp"])

    rows = docs.select(*key, text)
    return rows.mapInArrow(run, rows.select(*key, F.lit(0).cast("long").alias("fp")).schema)


def _cells(fp: Column) -> Column:
    """The grid cells of a fingerprint: ``half << 32 | counts`` with 2 bits per count."""
    pairs = F.lit(0x55555555)

    def counts(half: Column) -> Column:
        return half.bitwiseAND(pairs) + F.shiftrightunsigned(half, 1).bitwiseAND(pairs)

    low = counts(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = counts(F.shiftrightunsigned(fp, 32))
    cells = []
    for half, own in enumerate((low, high)):
        base = F.lit(half << 32)
        cells.append(own + base)
        for place in range(0, 32, 2):
            count = F.shiftrightunsigned(own, place).bitwiseAND(F.lit(3).cast("long"))
            cells.append(F.when(count > 0, own + base - F.lit(1 << place)))
            cells.append(F.when(count < 2, own + base + F.lit(1 << place)))
    return F.array_compact(F.array(*cells))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of signed numbers it counts the absolute value's


def _forest(fps: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Spanning links of one cell's fingerprints, by searching from one to the next."""
    left, right, todo = [], [], fps
    while len(todo):
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):
            near = _distance(todo, front[:1]) <= radius
            found = todo[near]
            left += [int(front[0])] * len(found)
            right += found.tolist()
            front, todo = np.concatenate([front[1:], found]), todo[~near]
    return left, right


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of each cell, from rows ``cell, block, fp`` sorted by cell and block."""

    def compare(cell: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(first, len(cell)))
        left, right = [], []
        for start, n in zip(first[size > SMALL_RUN].tolist(), size[size > SMALL_RUN].tolist(), strict=True):
            a, b = _forest(fps[start : start + n], radius)
            left.append(np.array(a, np.int64))
            right.append(np.array(b, np.int64))
        small = np.repeat(size <= SMALL_RUN, size)
        at = np.flatnonzero(small)
        for step in range(1, SMALL_RUN):
            at = at[at + step < len(cell)]
            at = at[cell[at] == cell[at + step]]
            if not len(at):
                break
            near = at[_distance(fps[at], fps[at + step]) <= radius]
            left.append(fps[near])
            right.append(fps[near + step])
        if not left:
            return pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    kept = None  # the last cell of a batch may go on in the next one
    for batch in batches:
        if kept is not None:
            batch = pa.concat_batches([kept, batch])
        key = batch.column(0).to_numpy() * 31 + batch.column(1).to_numpy()
        ends = np.flatnonzero(key[1:] != key[:-1])
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if cut:
            yield compare(key[:cut], batch.column(2).to_numpy()[:cut])
        kept = batch.slice(cut)
    if kept is not None and len(kept):
        key = kept.column(0).to_numpy() * 31 + kept.column(1).to_numpy()
        yield compare(key, kept.column(2).to_numpy())


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints ``fp`` that keep their components.

    A cell of more than ``BLOCK`` fingerprints is split into blocks by a hash, and each
    pair of blocks is compared apart, so that no task needs the whole cell.
    """
    if radius != RADIUS:
        raise ValueError("the cells one step away are made for links at 4 bits")
    entered = points.select("fp", F.explode(_cells(F.col("fp"))).alias("cell"))
    crowded = stage(
        entered.groupBy("cell").count().where(F.col("count") > BLOCK).select(
            "cell", F.ceil(F.col("count") * 2 / BLOCK).cast("int").alias("blocks")
        ),
        "crowded",
    )
    n = crowded.count()
    if n:
        entered = entered.join(checked_broadcast(crowded, n, BROADCAST_CELLS), "cell", "left")
        blocks = F.coalesce("blocks", F.lit(1))
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        pair = F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda other: (F.least(own, other) * blocks + F.greatest(own, other)).cast("long"),
        )
        entered = entered.select("cell", F.explode(pair).alias("block"), "fp")
    else:
        entered = entered.select("cell", F.lit(0).cast("long").alias("block"), "fp")
    dealt = entered.repartition("cell", "block").sortWithinPartitions("cell", "block")
    return dealt.mapInArrow(lambda it: _links(it, radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: list[str], text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: its ``key`` columns, ``fp`` and ``root``.

    Rows of equal ``root``, a fingerprint, are linked by steps of at most ``radius``
    bits. A null, empty or blank text has fingerprint zero and is linked like any
    other; texts below four words have one shingle. An empty table gives an empty
    result.
    """
    prints = stage(fingerprints(docs, key, text), "fingerprints")
    # In many parts, since every point is entered in some 50 cells.
    parts = 2 * shuffle_partitions(docs.sparkSession)
    counted = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    points = stage(counted.repartition(parts, "fp"), "points")
    found = stage(components(links(points, radius)), "components").select(
        F.col("node").alias("fp"), "root"
    )
    roots = points.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "n")
    return attach(prints, stage(roots, "roots"), ["fp"], "n").select(*key, "fp", "root")


def near_duplicate_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id that links reach. Null ids never name a component; one of null ids
    alone has none."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stage(near_duplicates(rows, ["doc_id"]), "near")
    names = found.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    return attach(found, stage(names, "names"), ["root"], "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id (null ids last).

    Null, empty and blank texts have fingerprint zero and are linked like any other. Of
    rows with equal ids one stays, told by its place in the table, so that no text is
    shuffled. An empty table gives an empty result.
    """
    rows = PlacedRows(docs)
    keyed = rows.docs.select(F.col(doc_id).alias("doc_id"), *rows.place, F.col(text).alias("text"))
    place = ["place_file", "place_row"]
    found = stage(near_duplicates(keyed, ["doc_id", *place]), "near")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *place)
    kept = found.groupBy("root").agg(F.min(rank).alias("kept"))
    return rows.only(kept.select(*(f"kept.{c}" for c in place)))
