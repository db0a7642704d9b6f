"""Passages that recur across documents, found by Aho-Corasick automata.

A window is ``WINDOW`` consecutive words. The steps:

1. Every window chooses an anchor, the phrase of ``ANCHOR`` words with the smallest
   hash in it. Equal windows choose equal anchors, so a window that recurs has an
   anchor that recurs; about one word in 22 starts an anchor.
2. Anchors of at least two documents are kept. Their windows are confirmed by an exact
   count: digests that occur in two documents or more, with the smallest document.
3. Confirmed phrases, written as the digests of their two blocks of 25 words, go into
   automata, sharded by anchor. The text around every recurring anchor is streamed
   through its shard's automaton, which gives all occurrences; a second digest of the
   whole window guards each of them.

Copies of whole word sequences are set aside before step 1, by their SHA-256: they lose
all words, and only text around recurring anchors is streamed, as nothing else can hold a
recurring window. Automata match block digests and not characters, which would need about
300 nodes a window; equality is that of two 64-bit digests of the window. Crowded shards
are split: the text by a salt, the phrases into parts, each piece of text meeting every part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.tables import checked_broadcast, shuffle_partitions, stage
from stridecast.llm.textbatch import BASES, Spans, Texts, Words, texts_of
from stridecast.operators.lookup import attach

WINDOW, ANCHOR = 50, 8
BLOCK = WINDOW // 2
#: Aims per task of step 3: phrases in an automaton, pieces of text that it reads, their bytes.
PHRASES, PIECES, PIECE_BYTES = 100_000, 50_000, 32_000_000
#: A shard is also split if it is crowded beside the others, but not below so many pieces and bytes.
EVEN, LEAST_PIECES, LEAST_BYTES = 2, 500, 500_000
#: So many shards' sizes are broadcast at most.
BROADCAST_SHARDS = 200_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Runs(NamedTuple):
    """Runs of windows with one anchor: the anchor, the text, first and last window."""

    anchor: np.ndarray
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchor_runs(words: Words, hashes: np.ndarray) -> Runs:
    windows = words.runs(WINDOW)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return Runs(none.astype(np.uint64), none, none, none)
    at = np.arange(len(hashes) - ANCHOR + 1)
    least, width, span = Spans(hashes)(at, at + ANCHOR), WINDOW - ANCHOR + 1, 1
    while span * 2 <= width:  # minima of 1, 2, 4, ... phrases
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchor, text = least[windows], words.text[windows]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    return Runs(anchor[first], text[first], windows[first], windows[last])


def _joined(texts: Texts, i: int) -> bytes:
    return b" ".join(texts.raw(i).split())


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, anchors = [], [], []
        for texts in texts_of(batch.column(2)):
            words = texts.words()
            runs = anchor_runs(words, words.hashes())
            counts += words.count.tolist()
            digests += [hashlib.sha256(_joined(texts, i)).hexdigest() for i in range(len(texts))]
            bounds = np.searchsorted(runs.text, np.arange(len(texts) + 1))
            signed = runs.anchor.view(np.int64)
            anchors += [signed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(anchors, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_key", "n_words", "sha", "anchors"],
        )


def _kept_runs(batch: pa.RecordBatch) -> Iterator[tuple[Texts, Words, np.ndarray, Runs]]:
    """Of each text, the runs whose numbers the batch lists: columns text and places."""
    places = batch.column(3)
    flat = places.flatten().to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(places.value_lengths().to_numpy(zero_copy_only=False)))
    for texts in texts_of(batch.column(2)):
        words = texts.words()
        hashes = words.hashes()
        runs = anchor_runs(words, hashes)
        start = np.searchsorted(runs.text, np.arange(len(texts)))
        mine = flat[ends[texts.first] : ends[texts.first + len(texts)]]
        owner = np.repeat(np.arange(len(texts)), np.diff(ends[texts.first : texts.first + len(texts) + 1]))
        pick = start[owner] + mine
        yield texts, words, hashes, Runs(*(x[pick] for x in runs))


def window_digests(words: Words, hashes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Both blocks of the windows that begin at ``start``, 32 bits each, and 64 bits of all."""
    block, whole = Spans(hashes), Spans(words.hashes(BASES[1]), BASES[1])
    high = np.uint64(32)
    return (
        (block(start, start + BLOCK) >> high).astype(np.int64),
        (block(start + BLOCK, start + WINDOW) >> high).astype(np.int64),
        whole(start, start + WINDOW).view(np.int64),
    )


def shard_of(anchor: np.ndarray, shards: int) -> np.ndarray:
    return ((anchor >> np.uint64(16)) % np.uint64(shards)).astype(np.int32)


def _windows(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for texts, words, hashes, runs in _kept_runs(batch):
                n = runs.last - runs.first + 1
                before = np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(runs.first, n) + np.arange(n.sum()) - before
                first, second, whole = window_digests(words, hashes, start)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array(np.repeat(shard_of(runs.anchor, shards), n)),
                        "blocks": pa.array(first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)).view(
                            pa.int64()
                        ),
                        "whole": pa.array(whole),
                        "doc_id": pa.array(np.repeat(ids[texts.first + runs.text], n)),
                    }
                )

    return run


def _pieces(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, words, _, runs in _kept_runs(batch):
                row = pa.array(texts.first + runs.text)
                data = texts.data.tobytes()
                begin, end = words.start[runs.first], words.end[runs.last + WINDOW - 1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array(shard_of(runs.anchor, shards)),
                        "doc_id": batch.column(0).take(row),
                        "text_key": batch.column(1).take(row),
                        "at": pa.array(runs.first - words.bounds[runs.text]),
                        "piece": pa.array(
                            [data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()
                        ),
                    }
                )

    return run


def automaton_of(blocks: np.ndarray) -> ahocorasick.Automaton:
    """An automaton of phrases, each the eight bytes of its two block digests; a phrase's
    value is its number. No linear list of a node's children is longer than 256."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    letters = blocks.astype(">u8").tobytes().decode("latin-1")
    for i in range(len(blocks)):
        found.add_word(letters[8 * i : 8 * i + 8], i)
    found.make_automaton()
    return found


def occurrences(automaton: ahocorasick.Automaton, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of all occurrences of phrases, and the phrases' numbers.

    Each of the 25 ways to cut a text into blocks is one stretch of the stream, every
    block four letters. A hit counts if it begins where a block does and its second
    block is in the same stretch.
    """
    begin = words.runs(BLOCK)
    place = begin - words.bounds[words.text[begin]]
    order = np.lexsort((place, place % BLOCK, words.text[begin]))
    begin = begin[order]
    symbol = (Spans(hashes)(begin, begin + BLOCK) >> np.uint64(32)).astype(">u4")
    hits = list(automaton.iter(symbol.tobytes().decode("latin-1")))
    if not hits:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end, phrase = np.array(hits, np.int64).T
    aligned = end % 4 == 3
    second, phrase = end[aligned] // 4, phrase[aligned]
    start = begin[second - 1]
    whole = begin[second] == start + BLOCK
    return start[whole], phrase[whole]


def _locate(left: pa.Table, right: pa.Table) -> pa.Table:
    """Stretches of words to remove, from pieces of text and the phrases of a shard."""
    out = {"doc_id": [], "text_key": [], "from": [], "to": []}
    if len(left) and len(right):
        phrases = right.select(["blocks", "whole", "owner"]).sort_by([("blocks", "ascending"), ("whole", "ascending")])
        blocks, whole, owner = (c.to_numpy() for c in phrases.columns)
        unique, first, count = np.unique(blocks.view(np.uint64), return_index=True, return_counts=True)
        automaton = automaton_of(unique)
        ids, keys = left.column("doc_id").to_numpy(), left.column("text_key").to_numpy()
        at = left.column("at").to_numpy()
        # The order of unsigned blocks differs from that of the sorted signed ones.
        for texts in texts_of(left.column("piece").combine_chunks().cast(pa.string())):
            words = texts.words()
            hashes = words.hashes()
            start, phrase = occurrences(automaton, words, hashes)
            digest = window_digests(words, hashes, start)[2]
            row = texts.first + words.text[start]
            repeated = np.zeros(len(start), bool)
            for k in range(int(count.max())):  # phrases that only the second digest tells apart
                one = first[phrase] + np.minimum(k, count[phrase] - 1)
                repeated |= (whole[one] == digest) & (owner[one] < ids[row])
            start, row = start[repeated], row[repeated]
            order = np.lexsort((start, row))
            start, row = start[order], row[order]
            new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + WINDOW))
            head = np.flatnonzero(new[: len(start)])
            tail = np.append(head[1:], len(start)) - 1
            shift = at[row[head]] - words.bounds[words.text[start[head]]]
            out["doc_id"].append(ids[row[head]])
            out["text_key"].append(keys[row[head]])
            out["from"].append(start[head] + shift)
            out["to"].append(start[tail[: len(head)]] + shift + WINDOW)
    return pa.table({k: pa.array(np.concatenate(v) if v else [], pa.int64()) for k, v in out.items()})


class Repeats(NamedTuple):
    """``profile``: a row per document with its copies' owner. ``texts``: the documents
    that have a recurring anchor. ``spans``: their stretches of words to remove."""

    profile: DataFrame
    texts: DataFrame
    spans: DataFrame


def find_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Repeats:
    """All passages of ``WINDOW`` words or more that also start in a smaller document.

    Rows are told apart by id and text; repeated rows count as one document. Rows with
    a null id neither own passages nor lose any. Null, empty, blank and short texts
    have no windows. Spans of one document may overlap.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("text"))
    profile = stage(
        rows.mapInArrow(
            _profile, "doc_id bigint, text_key bigint, n_words bigint, sha string, anchors array<bigint>"
        ),
        "profile",
    )
    copied = (
        profile.where((F.col("n_words") >= WINDOW) & F.col("doc_id").isNotNull())
        .groupBy("sha")
        .agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    profile = stage(attach(profile, stage(copied, "copies"), ["sha"], "n", how="left"), "owners")
    keys = ["doc_id", "text_key"]
    anchored = (
        profile.where(F.col("doc_id") == F.coalesce("owner", "doc_id"))
        .dropDuplicates(keys)
        .select(*keys, F.posexplode("anchors").alias("place", "anchor"))
    )
    anchored = stage(anchored, "anchors")
    recurring = (
        anchored.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
        .select("anchor")
    )
    places = stage(
        anchored.join(recurring, "anchor").groupBy(keys).agg(F.collect_list("place").alias("places")), "places"
    )
    pieces = places.agg(F.sum(F.size("places"))).first()[0] or 0
    shards = max(2 * shuffle_partitions(spark), -(-pieces // PIECES))
    texts = stage(
        rows.join(places, keys).dropDuplicates(keys).select(*keys, "text", "places"), "recurring"
    )
    windows = texts.mapInArrow(_windows(shards), "shard int, blocks bigint, whole bigint, doc_id bigint")
    phrases = stage(
        windows.groupBy("shard", "blocks", "whole")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("high"))
        .where("owner < high")
        .drop("high"),
        "phrases",
    )
    return Repeats(profile, texts, stage(_spans(texts, phrases, shards), "spans"))


def _spans(texts: DataFrame, phrases: DataFrame, shards: int) -> DataFrame:
    pieces = stage(
        texts.mapInArrow(
            _pieces(shards), "shard int, doc_id bigint, text_key bigint, at bigint, piece binary"
        ),
        "pieces",
    )
    # A phrase that a text repeats over and over makes one long piece.
    crowds = stage(
        pieces.groupBy("shard").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("piece")).alias("bytes")
        ),
        "crowds",
    )
    total = crowds.agg(F.sum("n"), F.sum("bytes")).first()
    each = [EVEN * (t or 0) / shuffle_partitions(pieces.sparkSession) for t in total]
    most = min(PIECES, max(LEAST_PIECES, each[0])), min(PIECE_BYTES, max(LEAST_BYTES, each[1]))
    salts = F.ceil(F.greatest(F.col("n") / most[0], F.col("bytes") / most[1])).cast("int")
    parts = F.ceil(F.count(F.lit(1)) / PHRASES).cast("int")
    sizes = crowds.select("shard", salts.alias("salts")).join(
        phrases.groupBy("shard").agg(parts.alias("parts")), "shard"
    )
    sizes = checked_broadcast(stage(sizes, "shards"), shards, BROADCAST_SHARDS)

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = (
        pieces.join(sizes, "shard")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "at"), "salts").cast("int"))
        .withColumn("part", every("parts"))
        .drop("salts", "parts")
    )
    right = (
        phrases.join(sizes, "shard")
        .withColumn("part", F.pmod("whole", "parts").cast("int"))
        .withColumn("salt", every("salts"))
        .drop("salts", "parts")
    )
    by = ("shard", "salt", "part")
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        _locate, "doc_id bigint, text_key bigint, `from` bigint, `to` bigint"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without the spans: number of words removed, digest and text of the others."""
    for batch in batches:
        removed, digests, kept = [], [], []
        for raw, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            words = raw.encode().split()
            keep = np.ones(len(words), bool)
            for span in spans:
                keep[span["from"] : span["to"]] = False
            left = b" ".join(words[i] for i in np.flatnonzero(keep).tolist())
            removed.append(len(words) - int(keep.sum()))
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept)],
            ["doc_id", "text_key", "n_removed", "kept_sha256", "kept_text"],
        )


def cut_texts(found: Repeats) -> DataFrame:
    """The documents that lose words: ``doc_id, text_key, n_removed, kept_sha256, kept_text``."""
    keys = ["doc_id", "text_key"]
    spans = found.spans.groupBy(keys).agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    cut = found.texts.join(spans, keys).select(*keys, "text", "spans")
    return cut.mapInArrow(
        _cut, "doc_id bigint, text_key bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``.

    Each word is removed that a window covers whose words also start in a document with
    a smaller id. The digest is that of the words left, joined by one space. See
    ``find_repeats`` for null ids, repeated rows and short texts; an empty table gives
    an empty result.
    """
    found = find_repeats(docs, text, doc_id)
    keys = ["doc_id", "text_key"]
    cut = cut_texts(found).drop("kept_text")
    copy = F.col("doc_id") > F.col("owner")
    return found.profile.join(cut, keys, "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
