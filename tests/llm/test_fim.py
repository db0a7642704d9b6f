"""Fill-in-the-middle texts against a plain version over code points."""

import hashlib
import random
import re

import pytest
from brute import sha
from pyspark.sql import functions as F

from stridecast.llm import fim

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.DOTALL)
SCHEMA = "doc_id bigint, text string, n bigint, form string, `row` int, Text2 string"


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(4)
    letters = "abcXYZ \n\t.,<>PSM012éüß日本𝒳́\x00"
    texts = [None, "", " ", "a", "日", "A<P>b", "x <M>", "<S>", "<P", "P><S", "<<P>>", "<" * 9, "\x00\n"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 300))) for _ in range(150)]
    texts += ["word " * 30_000, "w" * 200_000, "日本語" * 40_000, "<P <S <M" * 20_000]
    rows = [(i * 7 - 20, t) for i, t in enumerate(texts)]
    rows += [(None, "no id, twice"), (None, "no id, twice"), (3, "one id"), (3, "one id, another text"), (2**60, "far")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, cases):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in cases], SCHEMA).repartition(5).cache()


COLUMNS = ("n", "form", "prefix_chars", "middle_chars")


def test_digests_equal_brute_force(docs, cases, monkeypatch):
    found = sorted(map(tuple, fim.digests(docs).collect()), key=repr)
    expected = []
    for doc_id, text in cases:
        *known, output = plain(doc_id, text)
        expected.append((doc_id, *known, sha(output), sha(text or "")))
    assert found == sorted(expected, key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_texts_and_their_restoration(docs, cases):
    out = fim.transformed(docs)
    found = sorted(map(tuple, out.collect()), key=repr)
    assert found == sorted(((d, *plain(d, t)) for d, t in cases), key=repr)
    back = out.select("doc_id", fim.restored(F.col("form"), F.col("text")).alias("text"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((d, t or "") for d, t in cases), key=repr)


@pytest.mark.parametrize("piece, look", [(5, 7), (64, 16), (1 << 16, 1 << 20)])
def test_pieces_of_any_size(cases, monkeypatch, piece, look):
    monkeypatch.setattr(fim, "PIECE_BYTES", piece)
    monkeypatch.setattr(fim, "LOOK_BYTES", look)
    for doc_id, text in cases[:170]:
        if len(text or "") > 2_000:
            continue
        raw = (text or "").encode()
        header, pieces = fim.pieces_of(doc_id, raw)
        pieces = list(pieces)
        assert (*header[1:], b"".join(pieces)) == (*(known := plain(doc_id, text))[:-1], known[-1].encode())
        parts = sorted(enumerate(fim.sections(header.form, pieces)), key=lambda p: (p[1][0], p[0]))
        assert b"".join(part for _, (_, part) in parts) == raw


def test_pieces_end_between_units(monkeypatch):
    monkeypatch.setattr(fim, "PIECE_BYTES", 16)
    raw = ("some words, some more words and " * 20).encode()
    parts = list(fim._chunks(raw, 0, len(raw)))
    assert b"".join(parts) == raw and max(map(len, parts)) <= 16
    assert not any(a[-1:].isalpha() and b[:1].isalpha() for a, b in zip(parts, parts[1:]))


def test_only_one_shuffle(docs):
    report = fim.digests(docs)
    lineage = report.rdd.toDebugString().decode()
    assert lineage.count("ShuffledRDD") + lineage.count("PairwiseRDD") == 2  # the two ends of one shuffle


def test_more_tasks_for_more_bytes(docs, monkeypatch):
    monkeypatch.setattr(fim, "TASK_BYTES", 50_000)
    assert fim.sorted_pieces(docs, "text", "doc_id").getNumPartitions() > 15


def test_empty_table(docs):
    assert fim.digests(docs.limit(0)).collect() == [] == fim.transformed(docs.limit(0)).collect()


def test_long_text_in_pieces():
    import resource

    raw = ("Some words of a long text, " * 750_000).encode()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    header, pieces = fim.pieces_of(11, raw)
    for _ in fim.sections(header.form, pieces):
        pass
    assert header.n == sum(1 for _ in UNIT.finditer(raw.decode()))
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) < 150_000  # KB
