"""The ids of words and parts, and the places that the packer chooses."""

import random

import numpy as np
import pyarrow as pa
import pytest

from stridecast.llm import packing, textbatch
from stridecast.llm.queries import default_tokenizer
from stridecast.llm.textbatch import texts_of


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def odd_texts():
    draw = random.Random(8)
    bits = ["'s", "'S", "'t", "'re", "'RE", "'ve", "'m", "'ll", "'d", "'", "''", "'x", "12", "3", "ab", "É", "é", "ß", "ẞ", "ÿ", "Þ", "×", "÷", "µ", "<|", "|>", "<", ".", "...", "-", "日", "é", "́", " ", "\u0085", " ", "İ", "ﬁ", "\x00", "\x7f", "ª", "_"]
    return ["".join(draw.choice([*bits, " ", "\n", "word"]) for _ in range(draw.randrange(1, 40))) for _ in range(3_000)]


def test_ids_equal_the_tokenizer(tokenizer):
    texts = ["", None, " ", *odd_texts()]
    encode = packing.WordIds(default_tokenizer())
    for chunk in (64, 5_000, 1 << 20):
        for part in texts_of(pa.array(texts, pa.string()), chunk):
            ids, bounds = encode.of_texts(part)
            for i in range(len(part)):
                own = tokenizer.encode(texts[part.first + i] or "", add_special_tokens=False).ids
                assert ids[bounds[i] : bounds[i + 1]].tolist() == own


def test_long_texts_in_pieces(tokenizer, monkeypatch):
    monkeypatch.setattr(textbatch, "CHUNK_BYTES", 100)
    encode = packing.WordIds(default_tokenizer())
    for text in ("some words and more " * 40, "x" * 450, "a " + "b" * 250 + " c" * 90, "é" * 99 + " " * 120):
        pieces = list(textbatch.word_pieces(np.frombuffer(text.encode(), np.uint8)))
        assert b"".join(p.tobytes() for p in pieces) == text.encode()
        own = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == own


def test_words_with_equal_hashes_stay_apart(tokenizer, monkeypatch):
    real = textbatch.byte_hashes
    monkeypatch.setattr(textbatch, "byte_hashes", lambda *a: real(*a) % np.uint64(7))
    text = " ".join(odd_texts()[:100])
    ids = np.frombuffer(packing.WordIds(default_tokenizer())(text.encode()), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def best_levels(counts, size, capacity):
    """All levels (0: a new sequence) at which the sum of the squared counts is least."""
    sums = {}
    for level in range(capacity - size + 1):
        if level and not counts[level]:
            continue
        after = counts.copy()
        after[level] -= bool(level)
        if level + size < capacity:
            after[level + size] += 1
        sums[level] = int((after[1:] ** 2).sum())
    least = min(sums.values())
    return [level for level, s in sums.items() if s == least]


@pytest.mark.parametrize("low, high, most_open", [(1, 64, 1_000), (1, 20, 1_000), (24, 63, 12), (1, 63, 5)])
def test_levels_equal_brute_force(low, high, most_open):
    draw, packer = random.Random(low + high), packing.Packer(64, most_open=most_open)
    for d in range(3_000):
        size = draw.randrange(low, high)
        best = best_levels(packer.counts, size, 64)
        assert packer._level(size) == max(best)
        list(packer.add(d, np.full(size, d, "<u4")))
        own = np.zeros(65, int)
        for level, sequences in packer.open.items():
            own[level] = len(sequences)
            assert all(sum(len(ids) for *_, ids in s) == level for s in sequences)
        assert own.tolist() == packer.counts.tolist() and own.sum() == packer.n_open <= most_open


@pytest.mark.parametrize("low, high", [(1_500, 4_000), (1, 4_095), (2_100, 2_101), (4_000, 4_095)])
def test_the_levels_outlive_the_bound(low, high):
    draw, packer = random.Random(low), packing.Packer(most_open=64)
    sizes = [draw.randrange(low, high) for _ in range(4_000)]
    pieces, bound_met = [], 0
    for d, n in enumerate(sizes):
        before = packer.counts.copy()
        pieces += [(p[0], p[1], p[2].tolist(), p[3], p[4]) for p in packer.add(d, np.arange(n, dtype="<u4"))]
        # A document changes few levels, whether or not the bound is met.
        assert np.abs(packer.counts - before).sum() <= 6
        bound_met += packer.n_open == 64
    assert bound_met > 500
    pieces += [(p[0], p[1], p[2].tolist(), p[3], p[4]) for p in packer.flush()]
    documents, sequences = {}, {}
    for document, start, ids, sequence, offset in pieces:
        documents.setdefault(document, []).append((start, ids))
        sequences.setdefault(sequence, []).append((offset, len(ids)))
    for d, n in enumerate(sizes):
        assert [i for _, ids in sorted(documents[d]) for i in ids] == list(range(n))
    filled = []
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        filled.append(at)
    assert sum(f != 4096 for f in filled) <= 12 and all(f & (f - 1) == 0 for f in filled)
