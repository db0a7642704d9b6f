"""Mixing sources to target weights by repeating documents.

Words are summed per source, targets follow from the weights, and ``target / words`` is
a source's rate of repetition. A document is emitted ``floor(rate)`` times, and once
more if a hash of its id falls below the fraction: a Bernoulli draw that every rerun and
every partitioning repeats. A source's hash takes the one of ``SEEDS`` seeds whose draws
bring its words nearest to the target; one aggregate tries them all. That matters where
a few long documents hold much of a small source.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stridecast.llm.tables import WORD_CLASS, checked_broadcast, stage, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
SEEDS = 32
#: So many sources are broadcast at most (some MB).
BROADCAST_SOURCES = 50_000


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code point order (null last) take the weights in turn and share
    ``share`` of all words. A target stops at ``most`` times its source's words, and
    what is over goes to the others by weight. That filling ends where a source's
    target is ``min(weight * level, limit)``; the level follows from running sums over
    the sources in the order in which they fill up.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    turn = F.array(*map(F.lit, weights))
    filled = (
        totals.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", turn[(F.col("place") - 1) % len(weights)].cast("double"))
        .withColumn("limit", F.col("source_size") * F.lit(most))
        .withColumn("budget", F.sum("source_size").over(everywhere) * F.lit(share))
        .withColumn(
            "full_before",
            F.coalesce(
                F.sum("limit").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
            ),
        )
        .withColumn(
            "weight_left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
        )
        # The level if this source and all later ones stay below their limits.
        .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("weight_left"))
        .withColumn(
            "final",
            F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("full_before", "level")))
            .over(everywhere)["level"],
        )
    )
    target = F.when(
        F.col("final").isNull(), F.col("limit")
    ).otherwise(F.least(F.col("weight") * F.col("final"), F.col("limit")))
    return filled.select("source", "source_size", target.alias("target"))


def _extra(fraction: Column, seed: Column, *key: Column) -> Column:
    """One more copy (1 or 0): a draw from 48 bits of a hash of the seed and the key."""
    parts = (F.coalesce(k.cast("string"), F.lit("")) for k in (seed, *key))
    draw = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit("mix"), *parts)), 1, 12), 16, 10)
    return F.when(draw.cast("double") / F.lit(float(2**48)) < fraction, 1).otherwise(0)


def source_plan(sized: DataFrame) -> DataFrame:
    """``source, source_size, target, seed`` of each source, from ``doc_id, source, size``."""
    targets = _joinable(stage(source_targets(sized), "targets"))
    rate = F.col("target") / F.col("source_size")
    fraction = rate - F.floor(rate)
    missed = [
        F.abs(
            F.sum(F.col("size") * (F.floor(rate) + _extra(fraction, F.lit(k), F.col("doc_id"), F.col("size"))))
            - F.first("target")
        )
        for k in range(SEEDS)
    ]
    seeds = (
        sized.where("size > 0")
        .join(targets, F.col("source").eqNullSafe(F.col("mix_source")))
        .groupBy("mix_source")
        .agg(F.least(*(F.struct(m.alias("missed"), F.lit(k).alias("seed")) for k, m in enumerate(missed))).alias("best"))
        .select(F.col("mix_source").alias("of"), F.col("best.seed").alias("seed"))
    )
    return targets.join(seeds, F.col("mix_source").eqNullSafe(F.col("of")), "left").select(
        F.col("mix_source").alias("source"), "source_size", "target", F.coalesce("seed", F.lit(0)).alias("seed")
    )


def _joinable(targets: DataFrame) -> DataFrame:
    """A row per source, broadcast if they are few; else an ordinary join attaches them."""
    renamed = targets.withColumnRenamed("source", "mix_source")
    return checked_broadcast(renamed, targets.count(), BROADCAST_SOURCES)


def with_copies(sized: DataFrame, plan: DataFrame, doc_id: str, source: str, size: str) -> DataFrame:
    """``sized`` with ``mix_source_size, mix_target`` and ``mix_copies``."""
    plan = _joinable(plan).withColumnsRenamed(
        {"source_size": "mix_source_size", "target": "mix_target", "seed": "mix_seed"}
    )
    rate = F.coalesce(F.try_divide("mix_target", "mix_source_size"), F.lit(0.0))
    copies = F.floor(rate) + _extra(rate - F.floor(rate), F.col("mix_seed"), F.col(doc_id), F.col(size))
    return (
        sized.join(plan, F.col(source).eqNullSafe(F.col("mix_source")))
        .withColumn("mix_copies", copies.cast("int"))
        .drop("mix_source", "mix_seed")
    )


def _sizes(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    return stage(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size")
        ),
        "sizes",
    )


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_CLASS)).cast("long")


def mixed(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """The mix itself: each document as often as it is emitted, with its own columns.

    The size is the number of words (null text: 0). Null is a source of its own. A
    source without words has target 0 and its documents are not emitted. Rows of equal
    id, size and source draw alike. An empty table gives an empty result.
    """
    plan = stage(source_plan(_sizes(docs, text, doc_id, source)), "plan")
    sized = docs.select(
        F.struct("*").alias("doc"),  # whatever its columns are called
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
    )
    repeated = with_copies(sized, plan, "doc_id", "source", "size").where("mix_copies > 0")
    return repeated.select("doc", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select("doc.*")


def mix_report(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """One row per document, also of those not taken: ``doc_id, size, source_size, target,
    taken`` (words, copies counted). The same rules as for ``mixed``."""
    sized = _sizes(docs, text, doc_id, source)
    plan = stage(source_plan(sized), "plan")
    return with_copies(sized, plan, "doc_id", "source", "size").select(
        "doc_id",
        "size",
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("size") * F.col("mix_copies")).alias("taken"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''),
           '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size
  FROM documents
), t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, 2.0::DOUBLE * source_size AS most
  FROM t
), w AS (SELECT *, [3.0, 1.0, 2.0][((place - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM p),
f AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
    coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS before,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM w
), g AS (SELECT *, (budget - before) / rest AS level FROM f),
h AS (
  SELECT *, min(CASE WHEN level * weight <= most THEN {'a': before, 'b': level} END) OVER ()['b'] AS final FROM g
), s AS (
  SELECT source, source_size, CASE WHEN final IS NULL THEN most ELSE least(weight * final, most) END AS target
  FROM h
), e AS (
  SELECT d.doc_id, d.size, d.source, s.source_size, s.target,
    coalesce(s.target / nullif(s.source_size, 0), 0) AS rate
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), k AS (
  SELECT e.*, k.seed, floor(rate) + CASE WHEN
      ('0x' || md5(concat_ws('/', 'mix', k.seed::VARCHAR, coalesce(doc_id::VARCHAR, ''), size::VARCHAR))[1:12])::BIGINT
        / 281474976710656.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM e, range(32) k(seed)
), m AS (
  SELECT source, seed, abs(sum(size * copies) - any_value(target)) AS missed FROM k GROUP BY source, seed
), b AS (SELECT source, min({'m': missed, 's': seed})['s'] AS seed FROM m GROUP BY source)
SELECT k.doc_id, k.size::BIGINT AS size, k.source_size, k.target, (k.size * k.copies)::BIGINT AS taken
FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.seed = b.seed
"""
