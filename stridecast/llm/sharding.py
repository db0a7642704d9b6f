"""Shards by a weighted hash tree of regions, racks and shards.

A document descends the tree. At each level every child draws ``-ln(u) / weight`` from
a hash of the document's id and the child's name, and the smallest draw wins, so a
child gets its share by weight. A changed weight changes the draws of that child alone:
documents move only into or out of its subtree, and other subtrees keep theirs.

Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stridecast.llm.tables import stage, text_or_empty

#: region -> rack -> shard -> weight
Tree = Mapping[int, Mapping[int, Mapping[int, float]]]

RACKS_PER_REGION, SHARDS_PER_RACK, START = 2, 4, 16


def tree_of(shards: int) -> Tree:
    """The tree for so many shards of weight 1.

    The first 16 stand in two regions of two racks of four. Every later shard opens a
    region of its own: no other region's weight changes, so that it takes documents
    only into itself.
    """

    def place(shard: int) -> tuple[int, int]:
        per_region = RACKS_PER_REGION * SHARDS_PER_RACK
        if shard < START:
            return shard // per_region, shard % per_region // SHARDS_PER_RACK
        return START // per_region + shard - START, 0

    placed = [(*place(s), s) for s in range(shards)]
    return {
        region: {
            rack: {s: 1.0 for *_, s in leaves} for rack, leaves in groupby(racks, lambda p: p[1])
        }
        for region, racks in ((r, list(g)) for r, g in groupby(placed, lambda p: p[0]))
    }


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential draw of the given rate; 52 bits of hash, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 12)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**52))) / F.lit(float(weight))


def _first(children: Iterable[tuple[int, float]], key: Column, path: str) -> Column:
    draws = [
        F.struct(_draw(key, f"{path}/{child}", weight).alias("draw"), F.lit(child).alias("child"))
        for child, weight in children
        if weight > 0
    ]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["child"]


def _choose(case: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda c, w: c.when(*w), case[1:], F.when(*case[0]))


def shard_of(df: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """``df`` with the column ``name``: the shard that ``key`` descends to.

    Equal keys share a shard; all null keys share one.
    """
    weights = {
        r: {k: sum(leaves.values()) for k, leaves in racks.items()} for r, racks in tree.items()
    }
    region, rack, id_ = f"{name}_region", f"{name}_rack", F.col(key)
    df = df.withColumn(
        region, _first(((r, sum(w.values())) for r, w in weights.items()), id_, "region")
    )
    df = df.withColumn(
        rack,
        _choose([(F.col(region) == r, _first(w.items(), id_, f"rack/{r}")) for r, w in weights.items()]),
    )
    shard = _choose(
        [
            ((F.col(region) == r) & (F.col(rack) == k), _first(leaves.items(), id_, f"shard/{r}/{k}"))
            for r, racks in tree.items()
            for k, leaves in racks.items()
        ]
    )
    return df.withColumn(name, shard).drop(region, rack)


def sharded(
    docs: DataFrame, shards: int = START, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1. ``slot`` numbers a
    shard's rows from 0 without a gap: each written part numbers its own rows, and the
    counts of the parts before it are added, so no task sorts a whole shard.
    ``grown_shard`` is the shard with one more of them. Equal ids share a shard, also
    null ids; repeated rows get a slot each. An empty table gives an empty result.
    """
    body = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    rows = shard_of(rows, "doc_id", tree_of(shards), "shard")
    rows = shard_of(rows, "doc_id", tree_of(shards + 1), "grown_shard")
    rows = stage(rows.withColumn("part", F.spark_partition_id()), "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    )
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("first_slot") + F.col("place")).alias("slot"),
            "grown_shard",
        )
    )
