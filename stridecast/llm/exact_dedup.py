"""Exact duplicates: frequent digests apart from the others.

Misra-Gries summaries of the partitions, merged pairwise in a tree, hold every digest
with more than ``1/k`` of the rows. These candidates are counted exactly, and their
winners (at most ``k`` rows) are broadcast, so that no row of a frequent digest is
shuffled. ``k`` is four times the number of shuffle partitions, at least 256: a digest
that takes the ordinary shuffle has less than a quarter of an average task's rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stridecast.llm.tables import (
    SPACE_CLASS,
    PlacedRows,
    shuffle_partitions,
    stage,
    text_or_empty,
)

LEAST_COUNTERS = 256
#: Summaries that one task merges at a time.
FAN_IN = 64


def reduce_counters(counts: Counter, k: int) -> Counter:
    """Misra-Gries: take the (k+1)-th largest count from all and keep what is left."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return Counter({key: n - cut for key, n in counts.items() if n > cut})


def _summary(counts: Counter) -> pa.RecordBatch:
    keys, values = list(counts), list(counts.values())
    return pa.RecordBatch.from_pydict(
        {
            "digests": pa.array([keys], pa.list_(pa.binary())),
            "counts": pa.array([values], pa.list_(pa.int64())),
        }
    )


def frequent_digests(digests: DataFrame, k: int) -> DataFrame:
    """Up to ``k`` values of the binary column ``digest``, with every one that has more
    than ``1/(k+1)`` of the rows among them."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch.column(0).to_pylist())
            counts = reduce_counters(counts, k)
        if counts:
            yield _summary(counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for keys, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.update(dict(zip(keys, values, strict=True)))
                counts = reduce_counters(counts, k)
        if counts:
            yield _summary(counts)

    schema = "digests array<binary>, counts array<bigint>"
    summaries = digests.select("digest").mapInArrow(summarise, schema)
    width = digests.rdd.getNumPartitions()
    while width > 1:
        width = -(-width // FAN_IN)
        summaries = summaries.repartition(width).mapInArrow(merge, schema)
    return summaries.select(F.explode("digests").alias("digest"))


def _marked(docs: DataFrame, text: str, doc_id: str, *place: Column) -> DataFrame:
    """``doc_id``, the ``place`` columns, ``digest`` and ``row`` of every document, with its
    group's ``winner`` (a struct that ends in that row's ``id, row``) and ``group_size``."""
    spark = docs.sparkSession
    k = max(LEAST_COUNTERS, 4 * shuffle_partitions(spark))
    body = text_or_empty(text)
    rows = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            *place,
            F.char_length(body).alias("n"),
            F.unhex(F.sha2(F.regexp_replace(body, f"{SPACE_CLASS}+", ""), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    # The largest struct wins: most code points, then an id, then the smallest one.
    has_id = F.col("doc_id").isNotNull().alias("has_id")
    rank = F.struct("n", has_id, (-F.col("doc_id")).alias("id"), "row")
    candidates = stage(frequent_digests(rows, k), "candidates")
    winners = stage(
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max(rank).alias("winner"), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )
    frequent = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    others = rows.join(F.broadcast(candidates), "digest", "left_anti").withColumns(
        {"winner": F.max(rank).over(group), "group_size": F.count(F.lit(1)).over(group)}
    )
    return frequent.unionByName(others)


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without white space (U+0020, U+0009 to
    U+000D); a null text counts as empty, so all null, empty and blank texts form one
    group. The row with the most code points in the original text stays, then the one
    with the smallest id (null ids last), then, of repeated rows, any one of them.
    An empty table gives an empty result. Other columns are not looked at.
    """
    return _marked(docs, text, doc_id).select(
        "doc_id",
        (-F.col("winner.id")).alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that do not stay (see ``exact_groups``).

    The rows that stay are told by their place in the table, so that of rows equal in all
    columns one stays, and no text is shuffled. Null, empty and blank texts are one group.
    """
    rows = PlacedRows(docs)
    marked = _marked(rows.docs, text, doc_id, *rows.place)
    return rows.only(marked.where(F.col("row") == F.col("winner.row")).select("place_file", "place_row"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
