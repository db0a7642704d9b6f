"""Fingerprints by Order MinHash, which follow the edit distance.

The k-mers of a text are ``K`` consecutive words, each numbered by how often it has
occurred before, so that repeats count. A word of more than ``LONG_WORD`` bytes counts
as so many words of one code point, so that texts without white space (Chinese,
Japanese, Thai, encoded data) have k-mers as others do. Every one of ``HASHES`` hash functions selects
the ``PICKED`` k-mers with the smallest values, keeps them in the order of the text and
hashes that tuple. Two texts are alike by the share of equal tuples: moved passages
lower it as changed ones do.

The next document is found by range buckets of ids, each of which also holds the first
document of the next bucket: one shuffle, no task with all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.tables import shuffle_partitions
from stridecast.llm.textbatch import Spans, Texts, mix, texts_of

K, PICKED, HASHES = 2, 2, 64
LONG_WORD = 48
#: k-mers of one text that are hashed at a time.
PART = 1 << 14

_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _units(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, or code points of long words, and where each text's begin."""
    words = texts.words()
    long = words.end - words.start > LONG_WORD
    if not long.any():
        return words.hashes(), words.bounds
    edges = np.zeros(len(texts.data) + 1, np.int8)
    np.add.at(edges, words.start[long], 1)
    np.add.at(edges, words.end[long], -1)
    points = np.flatnonzero((np.cumsum(edges[:-1], dtype=np.int8) > 0) & (texts.data & 0xC0 != 0x80))
    word_end = words.end[long][np.searchsorted(words.start[long], points, side="right") - 1]
    ends = np.minimum(np.append(points[1:], len(texts.data)), word_end)
    start = np.concatenate([words.start[~long], points])
    order = start.argsort(kind="stable")
    start, end = start[order], np.concatenate([words.end[~long], ends])[order]
    return Spans(texts.data.astype(np.uint64) + np.uint64(1))(start, end), np.searchsorted(start, texts.bounds)


def _kmers(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all numbered k-mers, and where each text's begin.

    A text of fewer than ``K`` words has one k-mer, of all its words.
    """
    hashes, units = _units(texts)
    count = np.diff(units)
    count = np.where(count > 0, np.maximum(count - K + 1, 1), 0)
    text = np.repeat(np.arange(len(texts)), count)
    bounds = np.append(0, np.cumsum(count))
    start = units[text] + np.arange(bounds[-1]) - bounds[text]
    grams = Spans(hashes)(start, np.minimum(start + K, units[text + 1]))
    order = np.lexsort((grams, text))
    sorted_grams, sorted_text = grams[order], text[order]
    new = np.append(True, (sorted_grams[1:] != sorted_grams[:-1]) | (sorted_text[1:] != sorted_text[:-1]))
    first = np.flatnonzero(new[: len(order)])
    number = np.empty(len(order), np.uint64)
    number[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return mix(grams + number * np.uint64(0xD6E8FEB86659FD93)), bounds


def _smallest(kmers: np.ndarray) -> np.ndarray:
    """Positions of the ``PICKED`` smallest values of each hash function, in text order."""
    best = np.zeros((HASHES, 0), np.int64)
    for at in range(0, len(kmers), PART):
        values = kmers[at : at + PART] * _MULTIPLIERS[:, None]
        found = []
        rows = np.arange(HASHES)
        for _ in range(min(PICKED, values.shape[1])):
            least = values.argmin(axis=1)
            values[rows, least] = np.iinfo(np.uint64).max
            found.append(least + at)
        best = np.concatenate([best, np.stack(found, axis=1)], axis=1)
        if best.shape[1] > PICKED:
            value = kmers[best] * _MULTIPLIERS[:, None]
            best = np.take_along_axis(best, value.argsort(axis=1, kind="stable")[:, :PICKED], axis=1)
    return np.sort(best, axis=1)


def sketches(texts: Texts) -> np.ndarray:
    """One row of ``HASHES`` 16-bit tuple hashes per text; zeros for a text without words."""
    kmers, bounds = _kmers(texts)
    out = np.zeros((len(texts), HASHES), np.uint16)
    for i in range(len(texts)):
        own = kmers[bounds[i] : bounds[i + 1]]
        if len(own):
            total = np.zeros(HASHES, np.uint64)
            for picked in own[_smallest(own)].T:
                total = mix(total * np.uint64(31) + picked)
            out[i] = total >> np.uint64(48)
    return out


def sketch_of(texts: list[str]) -> np.ndarray:
    found = [sketches(t) for t in texts_of(pa.array(texts, pa.large_string()))]
    return np.concatenate(found) if found else np.zeros((0, HASHES), np.uint16)


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the next."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _rows(ids: list, texts: list[str], own: np.ndarray) -> pa.RecordBatch:
    """Results of all but the last text, which is only the next one of the one before."""
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    others = sketch_of(changed)
    hexed = [x.astype(">u2").tobytes().hex() for x in own]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids[:-1], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": pa.array(hexed[:-1], pa.string()),
            "edited_fingerprint": pa.array([x.astype(">u2").tobytes().hex() for x in others], pa.string()),
            "near_edited": pa.array((own[:-1] == others).mean(axis=1)),
            "near_next": pa.array((own[:-1] == own[1:]).mean(axis=1)),
        }
    )


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows ``bucket, extra, doc_id, text`` sorted by these; an extra row, the first
    of the next bucket, ends each bucket."""
    ids: list = []
    kept: list[str] = []
    sketch = np.zeros((0, HASHES), np.uint16)
    for batch in batches:
        extra = batch.column(1).to_numpy(zero_copy_only=False)
        doc_ids = batch.column(2).to_pylist()
        for part in texts_of(batch.column(3)):
            found = sketches(part)
            begin = 0
            stops = [*np.flatnonzero(extra[part.first : part.first + len(part)]).tolist(), None]
            for stop in stops:
                end = len(part) if stop is None else stop + 1
                texts = [*kept, *(part.raw(i).decode() for i in range(begin, end))]
                ids += doc_ids[part.first + begin : part.first + end]
                sketch = np.concatenate([sketch, found[begin:end]])
                if len(texts) > 1:
                    yield _rows(ids, texts, sketch)
                ended = stop is not None
                ids, kept, sketch = ([], [], sketch[:0]) if ended else (ids[-1:], texts[-1:], sketch[-1:])
                begin = end


def fingerprinted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The next document is that with the next larger id; after the last comes the first.
    Null ids come first, and rows of equal id are ordered by their text. A null text
    counts as empty; texts without words share one fingerprint. A table of one row is
    its own next; an empty table gives an empty result. The driver holds the bounds of
    the buckets, some per shuffle partition.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = 4 * shuffle_partitions(spark)
    ranges = rows.select("doc_id").where("doc_id IS NOT NULL").repartitionByRange(n, "doc_id")
    cuts = ranges.withColumn("range", F.spark_partition_id()).groupBy("range").agg(F.min("doc_id").alias("cut"))
    infinity = float("inf")
    splits = [-infinity, *(sorted({float(r["cut"]) for r in cuts.collect()}) or [0.0]), infinity]
    bucketizer = Bucketizer(splits=splits, inputCol="id", outputCol="bucket")

    def bucketed(df: DataFrame) -> DataFrame:
        known = df.withColumn("id", F.coalesce(F.col("doc_id").cast("double"), F.lit(-infinity)))
        return bucketizer.transform(known).withColumn("bucket", F.col("bucket").cast("int")).drop("id")

    heads = (
        bucketed(rows.select("doc_id"))
        .groupBy("bucket")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head"))
        .orderBy("bucket")
        .collect()
    )
    order = [r["bucket"] for r in heads]
    before = {order[i]: order[i - 1] for i in range(len(order))}  # of the first: the last
    firsts = spark.createDataFrame(
        [(r["head"]["doc_id"], before[r["bucket"]]) for r in heads], "head_id bigint, bucket int"
    )
    same = F.col("doc_id").eqNullSafe(F.col("head_id"))
    first_texts = (
        rows.join(F.broadcast(firsts), same).groupBy("doc_id", "bucket").agg(F.min("text").alias("text"))
    )
    own = bucketed(rows).select("bucket", F.lit(0).alias("extra"), "doc_id", "text")
    ends = first_texts.select("bucket", F.lit(1).alias("extra"), "doc_id", "text")
    dealt = own.unionByName(ends).repartition(n // 4, "bucket")
    return dealt.sortWithinPartitions("bucket", "extra", "doc_id", "text").mapInArrow(_stream, SCHEMA)
