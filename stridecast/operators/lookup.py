"""Joining per-key values back to rows, whatever the number and skew of the keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024

#: So many rows of one key may go to one task; a key with more is split by a salt.
ROWS_PER_TASK = 4_000_000
#: Keys that are split at most: beyond, keys have less than one in so many rows. The salts
#: of so many keys are broadcast.
MOST_SPLIT = 100_000
#: Parts over which the rows without a key are spread in an outer join.
_NULL_PARTS = 1024

_SPLITS, _PART = "_lookup_splits", "_lookup_part"


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of ``df``, measured by one aggregate over it."""
    return df.agg(F.sum(_size(df))).first()[0] or 0


def _size(df: DataFrame) -> Column:
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        size = size + F.lit(16)
    return size


def split_above(total_rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Keys with more rows than this are split: at most ``MOST_SPLIT`` can have them."""
    return max(rows_per_task, -(-total_rows // MOST_SPLIT))


def _row_hash(rows: DataFrame) -> Column:
    """A hash of the row, which any rerun repeats. Maps have none."""
    hashed = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*(F.col(f"`{c}`") for c in hashed))


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    weight: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    how: str = "inner",
) -> DataFrame:
    """Join of ``rows`` with ``lookup``, which has one row per key and should be a table.

    The lookup is measured first, by one aggregate over it; the rows are read once. Up
    to ``broadcast_bytes`` it is broadcast and the rows do not move. Beyond that there is
    one shuffle join. ``weight`` names the lookup column with the rows per key: a key
    with more than ``rows_per_task`` is split by a hash of its rows, over as many parts
    as its rows need, and its lookup row is repeated for each part. Rows with equal
    values stay together; adaptive execution splits what remains skewed. ``weight`` is
    not part of the result. Columns of the same name in ``rows`` are replaced.
    """
    keys = list(keys)
    added = [c for c in lookup.columns if c not in keys and c != weight]
    rows = rows.drop(*added)
    columns = [*rows.columns, *added]
    values = lookup.select(*keys, *added)

    measured = lookup.agg(
        F.sum(_size(values)).alias("bytes"),
        F.sum(weight).alias("rows"),
        F.max(weight).alias("most"),
    ).first()
    if (measured.bytes or 0) <= broadcast_bytes:
        return rows.join(F.broadcast(values), keys, how).select(*columns)

    limit = split_above(measured.rows, rows_per_task)
    parts = F.ceil(F.col(weight) / F.lit(float(limit))).cast("int")
    if measured.most > limit:
        salts = lookup.where(F.col(weight) > limit).select(*keys, parts.alias(_SPLITS))
        rows = rows.join(F.broadcast(salts), keys, "left")
        splits = F.coalesce(_SPLITS, F.lit(1))
        part = F.greatest(parts, F.lit(1))
        values = lookup.select(*keys, *added, F.explode(F.sequence(F.lit(0), part - 1)).alias(_PART))
    else:
        splits = F.lit(1)
        values = values.withColumn(_PART, F.lit(0))
    if how != "inner":  # rows without a key find nothing wherever they go
        keyless = F.lit(False)
        for k in keys:
            keyless = keyless | F.col(k).isNull()
        splits = F.when(keyless, _NULL_PARTS).otherwise(splits)
    rows = rows.withColumn(_PART, F.pmod(_row_hash(rows), splits).cast("int"))
    return rows.join(values, [*keys, _PART], how).select(*columns)
