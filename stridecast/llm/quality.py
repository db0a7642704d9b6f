"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines before
and after it; transitions make neighbours agree. Forward-backward gives the probability
of good for each line, and a document's score is their mean, weighted by length and
put on the scale of the labels by a logistic fit.

Labels are known for documents, so in training all lines carry their document's label;
what a line alone cannot tell is left to its neighbours and to the average. The field
is fitted on about ``SAMPLE_DOCS`` labelled documents, chosen by a hash, of at most
``SAMPLE_LINES`` lines in all. Every document is scored, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.tables import held_out, text_or_empty
from stridecast.llm.textbatch import Spans, Texts, texts_of

#: Expected labelled documents that the field is fitted on, and steps of the fit.
SAMPLE_DOCS, STEPS, RATE, PENALTY = 4000, 300, 0.05, 1e-3
THRESHOLD = 0.3

#: Most lines of all documents that the field is fitted on: about 600 bytes each on the
#: driver. Whole documents are picked, in the order of the hash, while they fit.
SAMPLE_LINES = 400_000
#: Texts of more lines are worked on in pieces of so many, side by side.
PIECE = 1024

_KIND = np.full(256, 0, np.uint8)  # 0: other control characters
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[ord("A") : ord("Z") + 1] = 3
_KIND[ord("a") : ord("z") + 1] = 4
_KIND[0x80:] = 5
_PUNCTUATION = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_KIND[_PUNCTUATION] = np.arange(6, 6 + len(_PUNCTUATION))
KINDS = 6 + len(_PUNCTUATION)
#: Features of a line: roots of the shares of all kinds of bytes, and five more.
FEATURES = KINDS + 5


def line_features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and where each text's lines begin.

    Every text has at least one line; an empty line has length 1.
    """
    data = texts.data
    breaks = np.flatnonzero(data == 0x0A) + 1
    starts = np.sort(np.concatenate([texts.bounds[:-1], breaks]), kind="stable")
    # A break at a text's end opens a last, empty line that belongs to that text.
    text = np.sort(
        np.concatenate([np.arange(len(texts)), np.searchsorted(texts.bounds, breaks, side="left") - 1]), kind="stable"
    )
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    ends = np.append(starts[1:], len(data))
    length = np.maximum(ends - starts, 1)
    line = np.repeat(np.arange(len(starts)), ends - starts)
    counts = np.bincount(line * KINDS + _KIND[data], minlength=len(starts) * KINDS)
    out = np.zeros((len(starts), FEATURES), np.float32)
    out[:, :KINDS] = np.sqrt(counts.reshape(-1, KINDS) / length[:, None])

    words = texts.words()
    hashes = words.hashes()
    of_line = np.searchsorted(starts, words.start, side="right") - 1
    n_words = np.bincount(of_line, minlength=len(starts))
    letters = np.bincount(of_line, words.end - words.start, minlength=len(starts))
    out[:, KINDS] = letters / np.maximum(n_words, 1) / 10
    out[:, KINDS + 1] = np.bincount(of_line, _seen(hashes, words.text), minlength=len(starts)) / np.maximum(n_words, 1)
    same = _seen(Spans(data.astype(np.uint64) + np.uint64(1))(starts, ends), text)
    out[:, KINDS + 2] = same
    out[:, KINDS + 3] = np.log(length) / 8
    out[:, KINDS + 4] = np.log(np.diff(bounds))[text] / 5
    return out, length, bounds


def _seen(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """1 where a value has occurred before in its group, else 0."""
    order = np.lexsort((values, group))
    again = np.zeros(len(values))
    same = (values[order][1:] == values[order][:-1]) & (group[order][1:] == group[order][:-1])
    again[order[1:]] = same
    return again


def with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero at a text's ends), and 1."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    return np.concatenate([features, before, after, np.ones((len(features), 1), features.dtype)], axis=1)


def _step(message: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log-odds of a neighbour from log-odds and transitions ``t[here, there]``."""
    return np.logaddexp(message + t[1, 1], t[0, 1]) - np.logaddexp(message + t[1, 0], t[0, 0])


def _walk(out: np.ndarray, unary: np.ndarray, first: np.ndarray, count: np.ndarray, t: np.ndarray) -> None:
    """Forward log-odds of runs of lines, of which those of the first lines are there."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    longest = int(count[0]) if len(count) else 0
    alive = np.searchsorted(-count, -np.arange(longest), side="left")  # runs with more lines
    for i in range(1, longest):
        at = first[: alive[i]] + i
        out[at] = unary[at] + _step(out[at - 1], t)


def _across(unary: np.ndarray, first: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log weights ``[before, last, piece]`` of the ways through whole pieces."""
    ways = np.repeat(t[:, :, None], len(first), axis=2)
    for i in range(PIECE):
        if i:
            ways = np.logaddexp(ways[:, :1] + t[0][:, None], ways[:, 1:] + t[1][:, None])
        ways[:, 1] += unary[first + i]
    return ways


def _forward(unary: np.ndarray, bounds: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Forward log-odds (with the line's own) of all lines."""
    out, first, count = unary.copy(), bounds[:-1], np.diff(bounds)
    _walk(out, unary, first, np.minimum(count, PIECE), t)
    pieces = -(-count // PIECE)
    more = np.flatnonzero(pieces > 1)
    if not len(more):
        return out
    text = np.repeat(more, pieces[more] - 1)  # of all pieces but the first ones
    number = np.concatenate([np.arange(1, n) for n in pieces[more]])
    begin = first[text] + number * PIECE
    length = np.minimum(bounds[1:][text] - begin, PIECE)
    ways = np.zeros((2, 2, len(begin)))
    whole = length == PIECE
    ways[:, :, whole] = _across(unary, begin[whole], t)
    message = out[begin - number * PIECE + PIECE - 1]  # from the text's first piece
    for k in range(len(begin)):
        if number[k] > 1:
            message[k] = _step(message[k - 1], ways[:, :, k - 1])
    out[begin] = unary[begin] + _step(message, t)
    _walk(out, unary, begin, length, t)
    return out


def messages(unary: np.ndarray, bounds: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward log-odds (with the line's own) and backward log-odds (without) of all lines."""
    forward, backward = _forward(unary, bounds, t), np.zeros_like(unary)
    own = _forward(unary[::-1], len(unary) - bounds[::-1], t.T)[::-1]
    inner = np.ones(len(unary), bool)
    inner[bounds[1:] - 1] = False
    here = np.flatnonzero(inner)
    backward[here] = _step(own[here + 1], t.T)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def weighted_mean(values: np.ndarray, weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values * weight, bounds[:-1]) / np.add.reduceat(weight.astype(float), bounds[:-1])


@dataclass(frozen=True)
class Field:
    """Weights of the features, transitions ``[here, there]`` and the final scale."""

    weights: np.ndarray
    transitions: np.ndarray
    scale: tuple[float, float]

    def marginals(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        unary = with_neighbours(features, bounds) @ self.weights
        forward, backward = messages(unary.astype(float), bounds, self.transitions)
        return _sigmoid(forward + backward)

    def quality(self, features: np.ndarray, length: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        raw = weighted_mean(self.marginals(features, bounds), length, bounds)
        return _sigmoid(self.scale[0] * _logit(raw) + self.scale[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class _Adam:
    def __init__(self, *values: np.ndarray):
        self.values = [v.astype(float) for v in values]
        self.first = [np.zeros_like(v) for v in self.values]
        self.second = [np.zeros_like(v) for v in self.values]
        self.n = 0

    def step(self, *gradients: np.ndarray) -> None:
        self.n += 1
        for v, a, b, g in zip(self.values, self.first, self.second, gradients, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            v -= RATE * (a / (1 - 0.9**self.n)) / (np.sqrt(b / (1 - 0.999**self.n)) + 1e-8)


def train(features: np.ndarray, length: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Field:
    """A field from lines with the labels of their documents: the mean gradient of the
    lines' log-likelihood, by Adam, with an L2 penalty."""
    x = with_neighbours(features, bounds)
    y = np.repeat(labels, np.diff(bounds)).astype(float)
    inner = np.ones(len(y), bool)
    inner[bounds[1:] - 1] = False
    here = np.flatnonzero(inner)
    share = np.repeat(1 / np.diff(bounds), np.diff(bounds)) / len(labels)  # every document counts alike
    fit = _Adam(np.zeros(x.shape[1]), np.zeros((2, 2)))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[here].astype(int), y[here].astype(int)), share[here])
    for _ in range(STEPS):
        weights, t = fit.values
        unary = x @ weights
        forward, backward = messages(unary, bounds, t)
        p = _sigmoid(forward + backward)
        ahead = unary[here + 1] + backward[here + 1]
        joint = np.stack([np.stack([np.full(len(here), t[a, b]) + a * forward[here] + b * ahead for b in (0, 1)]) for a in (0, 1)])
        joint = np.exp(joint - joint.max(axis=(0, 1)))
        joint /= joint.sum(axis=(0, 1))
        fit.step(x.T @ ((p - y) * share) + PENALTY * weights, (joint * share[here]).sum(axis=2) - seen + PENALTY * t)
    field = Field(fit.values[0].astype(np.float32), fit.values[1], (1.0, 0.0))
    raw = _logit(weighted_mean(field.marginals(features, bounds), length, bounds))
    scale = _Adam(np.array([1.0, 0.0]))
    for _ in range(STEPS):
        off = (_sigmoid(scale.values[0][0] * raw + scale.values[0][1]) - labels) / len(labels)
        scale.step(np.array([(off * raw).sum(), off.sum()]))
    return Field(field.weights, field.transitions, tuple(scale.values[0].tolist()))


def _sampled_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        quality = batch.column(0).to_numpy()
        for texts in texts_of(batch.column(1)):
            features, length, bounds = line_features(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(quality[texts.first : texts.first + len(texts)]),
                    pa.array([features[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    pa.array([length[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                ],
                ["quality", "features", "length"],
            )


def _beyond(drawn: list) -> list:
    """Ids of the drawn documents (``label_id, lines, draw``) that no longer fit."""
    left, beyond = SAMPLE_LINES, []
    for r in sorted(drawn, key=lambda r: (r["draw"], r["label_id"])):
        if r["lines"] <= left:
            left -= r["lines"]
        else:
            beyond.append(r)
    if len(beyond) == len(drawn) and drawn:
        beyond.remove(min(beyond, key=lambda r: (r["lines"], r["draw"])))
    return [r["label_id"] for r in beyond]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Field | None:
    """A field from the labelled documents that are not held out; None if there are none.

    The features of the sample's lines come to the driver, at most ``SAMPLE_LINES``; a
    longer document is not learned from, unless all are longer: then the shortest is. Of repeated labels of one id
    the larger counts; null labels are left out.
    """
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isNotNull() & ~held_out("label_id"))
        .groupBy("label_id")
        .agg(F.max("quality").alias("quality"))
    )
    n = known.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.lit("quality"), "label_id"), F.lit(1 << 20))
    chosen = known.where(draw < min(1.0, SAMPLE_DOCS / n) * (1 << 20))
    rows = docs.select(F.col(doc_id).alias("label_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "label_id")
    lines = rows.groupBy("label_id").agg(F.sum(F.regexp_count(text_or_empty(), F.lit("\n")) + 1).alias("lines"))
    left_out = _beyond(lines.withColumn("draw", draw).collect())
    if left_out:
        rows = rows.where(~F.col("label_id").isin(left_out))
    sample = (
        rows.select("quality", "text")
        .mapInArrow(_sampled_lines, "quality int, features binary, length binary")
        .toArrow()
    )
    if not len(sample):
        return None
    features = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in sample["features"].to_pylist()]
    length = [np.frombuffer(b, np.int64) for b in sample["length"].to_pylist()]
    # In a fixed order, so that the fit does not depend on the order of the rows.
    order = sorted(range(len(length)), key=lambda i: (len(length[i]), features[i].tobytes()))
    bounds = np.append(0, np.cumsum([len(length[i]) for i in order]))
    quality = sample["quality"].to_numpy()[order]
    return train(np.concatenate([features[i] for i in order]), np.concatenate([length[i] for i in order]), bounds, quality)


def with_quality(docs: DataFrame, field: Field | None, text: str = "text", score: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``score``, 0 to 1; 0.5 if nothing was learned.

    A null or empty text is scored as one empty line. Any other columns stay; one named
    ``score``, in any case, is replaced. Equal texts have equal scores. An empty table
    gives an empty one.
    """
    docs = docs.drop(score)
    if field is None:
        return docs.withColumn(score, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.quality(*line_features(t)) for t in texts_of(batch.column(place))]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, score])

    return docs.mapInArrow(run, docs.withColumn(score, F.lit(0.0)).schema)


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null or empty text is scored as one empty line; equal texts have equal scores;
    repeated rows and null ids (never held out) are scored as others. Without labels all
    scores are 0.5. An empty table gives an empty result. Other columns are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text")
    )
    out = with_quality(rows, fit(docs, labels, text, doc_id), score="score")
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that the field rejects.

    Documents are judged by their text alone (null: empty), so of repeated rows all or
    none stay. All columns stay as they are, whatever their names.
    """
    score = "quality_score"
    while score in map(str.lower, docs.columns):
        score += "_"
    out = with_quality(docs, fit(docs, labels, text, doc_id), text, score)
    return out.where(F.col(score) >= THRESHOLD).drop(score)
