"""Languages by bit-sliced Bloom filters of character n-grams.

The filter has ``SLOTS`` slots with one bit per language. An n-gram has three slots; the
AND of their masks names, in one look-up each, every language that contains it. A text's
hits are counted per language, the share expected from false positives is taken off,
and the language with most hits is predicted.

A language contains an n-gram if it occurs at least twice in its sample and at least
``RELATIVE`` as often, in proportion, as in the language where it is most frequent.
The model is fitted on about ``SAMPLE_DOCS`` documents per language, chosen by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stridecast.llm.tables import held_out, stage
from stridecast.llm.textbatch import mix, texts_of

ORDERS = (3, 4)
SLOT_BITS, LOOKUPS = 21, 3
SLOTS = 1 << SLOT_BITS
#: Expected documents per language that the filters are fitted on.
SAMPLE_DOCS = 2000
RELATIVE = 0.25
UNKNOWN = "und"

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all n-grams of some texts, and the number of each one's text.

    Texts are lower-cased. An n-gram lies in one word, that is a run of letters, but may
    begin or end with the word's edge.
    """
    lowered = [f" {t.lower()} " for t in texts]
    length = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    letter = _is_letter()[points]
    values = np.where(letter, points, 0).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), length)
    hashes, owners = [], []
    for n in ORDERS:
        inner = letter[1 : len(letter) - n + 2].copy()
        for i in range(2, n - 1):
            inner &= letter[i : len(letter) - n + 1 + i]
        at = np.flatnonzero(inner)
        total = np.full(len(at), n, np.uint64)
        for i in range(n):
            total += values[at + i] * _ODD[i]
        hashes.append(mix(total))
        owners.append(text[at + 1])
    return np.concatenate(hashes), np.concatenate(owners)


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    return [(grams >> np.uint64(SLOT_BITS * i)) & np.uint64(SLOTS - 1) for i in range(LOOKUPS)]


@dataclass(frozen=True)
class Filters:
    """``masks[slice][slot]``: bit ``l`` of slice ``s`` stands for language ``64 * s + l``."""

    languages: list[str]
    masks: np.ndarray
    common: str

    def rates(self) -> np.ndarray:
        """Per language, how often an n-gram it does not contain is found all the same."""
        filled = [(self.masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(self.languages))]
        return np.array(filled) ** LOOKUPS

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams per text, and hits per text and language."""
        grams, owner = grams_of(texts)
        slots = _slots(grams)
        hits = np.zeros((len(texts), len(self.languages)))
        for part, masks in enumerate(self.masks):
            found = masks[slots[0]]
            for s in slots[1:]:
                found &= masks[s]
            for i in range(64 * part, min(64 * part + 64, len(self.languages))):
                bit = (found >> np.uint64(i % 64)) & np.uint64(1)
                hits[:, i] = np.bincount(owner[bit.astype(bool)], minlength=len(texts))
        return np.bincount(owner, minlength=len(texts)), hits

    def predict(self, texts: list[str], rates: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total, hits = self.hits(texts)
        true = np.maximum(hits - total[:, None] * rates, 0) / np.maximum(1 - rates, 1e-9)
        best, mass = true.argmax(axis=1), true.sum(axis=1)
        score = np.divide(true.max(axis=1), mass, out=np.zeros(len(texts)), where=mass > 0)
        names = [
            UNKNOWN if not n else self.languages[b] if m > 0 else self.common
            for n, b, m in zip(total, best, mass, strict=True)
        ]
        return names, np.where(total > 0, score, 0.0)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = batch.column(0).to_numpy()
        for texts in texts_of(batch.column(1)):
            grams, owner = grams_of([texts.raw(i).decode() for i in range(len(texts))])
            language = languages[texts.first + owner]
            for one in np.unique(language):
                values, counts = np.unique(grams[language == one], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), one)), pa.array(values.view(np.int64)), pa.array(counts)],
                    ["language", "gram", "n"],
                )


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> Filters:
    """Filters from the documents that are not held out and have a language and a text.

    Only the languages' names and counts and the filled slots (at most ``SLOTS`` per 64
    languages) come to the driver.
    """
    spark = docs.sparkSession
    known = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = known.groupBy(F.col(lang).alias("lang")).count().orderBy("lang").collect()
    languages = [r["lang"] for r in counted]
    if not languages:
        return Filters([], np.zeros((0, SLOTS), np.uint64), UNKNOWN)
    numbers = spark.createDataFrame(
        [(r["lang"], i, min(1.0, SAMPLE_DOCS / r["count"])) for i, r in enumerate(counted)],
        "lang string, language long, share double",
    )
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col(doc_id)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = (
        known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
        .join(F.broadcast(numbers), "lang")
        .where("draw < share")
        .select("language", "text")
    )
    counts = stage(
        sample.mapInArrow(_count_grams, "language bigint, gram bigint, n bigint")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    rate = F.col("n") / F.col("total")
    contained = (
        counts.join(F.broadcast(totals), "language")
        .withColumn("most", F.max(rate).over(Window.partitionBy("gram")))
        .where((F.col("n") >= 2) & (rate >= F.col("most") * RELATIVE))
    )
    bit = F.expr("shiftleft(1L, cast(language % 64 as int))")
    slots = F.array(
        *(F.shiftrightunsigned("gram", SLOT_BITS * i).bitwiseAND(F.lit(SLOTS - 1).cast("long")) for i in range(LOOKUPS))
    )
    filled = (
        contained.select(F.explode(slots).alias("slot"), F.floor(F.col("language") / 64).alias("part"), bit.alias("bit"))
        .groupBy("part", "slot")
        .agg(F.bit_or("bit").alias("mask"))
        .toArrow()
    )
    masks = np.zeros((-(-len(languages) // 64), SLOTS), np.uint64)
    masks[filled["part"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    common = max(counted, key=lambda r: (r["count"], r["lang"]))["lang"]
    return Filters(languages, masks, common)


def predict(docs: DataFrame, filters: Filters, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    The prediction uses the text only. ``und`` with score 0 if the text is null or has
    no letter, or nothing was learned; the most frequent language with score 0 if no
    language contains any of the n-grams; of equal languages the first by name. The
    score is the language's share of all corrected hits.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        rates = model.rates()
        for batch in batches:
            names, scores = [], []
            for texts in texts_of(batch.column(2)):
                name, score = model.predict([texts.raw(i).decode() for i in range(len(texts))], rates)
                names += name
                scores += score.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
