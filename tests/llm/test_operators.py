"""Each operator on a small table of odd cases, and on the given small tables."""

import hashlib
import os
import random
import re
import zlib
from functools import partial

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stridecast.llm import (
    exact_dedup,
    langid,
    license,
    mixing,
    omh,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    tables,
)
from stridecast.llm.components import components
from stridecast.llm.queries import QUERIES, default_tokenizer
from stridecast.llm.textbatch import texts_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, root long, mix_size int, key int, quality_score int"


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(["the", "of", "river", "Stone", "light", "and", "über", "x1"]) + str(draw.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def cases():
    """(doc_id, text): nulls, blanks, ties, copies, near copies, a shared passage, long texts."""
    shared = prose(7, 80)
    long = prose(8, 20_000)
    texts = [None, "", " \t\n", "one", "ONE", "two words", "a  b c\x0bd", "日本 語 <|endoftext|> İx"]
    texts += [prose(1, 300), prose(1, 300), prose(1, 300) + " ", prose(1, 300).replace("light1", "lamp", 1)]
    texts += [prose(i, 60) + " " + shared + " " + prose(i + 50, 90) for i in range(20, 26)]
    texts += [shared, long, long + " end", prose(9, 49), prose(9, 50), prose(9, 51), "Released under the MIT License. " + prose(3, 20)]
    return [(3 * i + 5, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, cases):
    rows = [(i, t, "en", None if k % 4 == 0 else f"s{k % 3}", None, "x", 1, 2, 3, 4) for k, (i, t) in enumerate(cases)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def given(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


EXACT = ("keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups(docs, cases):
    assert by_id(exact_dedup.exact_groups(docs), *EXACT) == brute.exact(cases)


def test_exact_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "ab"), (None, "c")], "doc_id bigint, text string")
    out = exact_dedup.exact_groups(df).collect()
    assert [r["kept"] for r in out if r["group_size"] == 3].count(True) == 1
    assert sorted(r["keep_id"] or -1 for r in out) == [-1, 1, 1, 1]
    assert sorted(exact_dedup.distinct_texts(df).collect(), key=repr) == [(1, "a b"), (None, "c")]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def test_kept_rows_of_a_table_do_not_move(spark, cases, tmp_path):
    rows = [*cases, cases[9], (None, cases[9][1]), (None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    table = spark.read.parquet(f"{tmp_path}/docs")
    for operator in (exact_dedup.distinct_texts, simhash.representatives):
        out = operator(table)
        assert shuffles(out) == 0
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(
            map(tuple, operator(spark.createDataFrame(rows, table.schema)).collect()), key=repr
        )


@pytest.mark.parametrize("broadcast_bytes", [64 * 1024 * 1024, -1])
def test_rows_picked_by_place(spark, tmp_path, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(tables, "attach", partial(tables.attach, broadcast_bytes=broadcast_bytes))
    spark.range(200_000).selectExpr("id % 7 as id", "id as Doc").coalesce(2).write.parquet(f"{tmp_path}/rows")
    rows = tables.PlacedRows(spark.read.parquet(f"{tmp_path}/rows"))
    places = rows.docs.select("Doc", *rows.place)
    wanted = places.where("Doc % 11 = 3 or Doc between 60000 and 70000")
    got = rows.only(wanted.select("place_file", "place_row"))
    assert got.columns == ["id", "Doc"]
    assert sorted(r["Doc"] for r in got.collect()) == [i for i in range(200_000) if i % 11 == 3 or 60000 <= i <= 70000]


def test_misra_gries_finds_frequent_digests(spark):
    values = [b"hot"] * 700 + [b"warm"] * 250 + [str(i).encode() for i in range(900)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "digest binary").repartition(80)
    found = {bytes(r[0]) for r in exact_dedup.frequent_digests(df, 16).collect()}
    assert {b"hot", b"warm"} <= found and len(found) <= 16


def test_near_duplicates(docs, cases):
    assert by_id(simhash.near_duplicate_groups(docs), "fingerprint", "component_id") == brute.near(cases)


def test_crowded_cells_lose_no_link(spark, monkeypatch):
    draw = random.Random(2)
    base = draw.getrandbits(64)
    fps = {base ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(7))) for _ in range(400)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "SMALL_RUN", 4)
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    found = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    todo, expected = set(signed), {}
    while todo:
        front = [todo.pop()]
        group = set(front)
        while front:
            at = front.pop()
            near = {f for f in todo if ((f ^ at) & (2**64 - 1)).bit_count() <= 4}
            todo -= near
            group |= near
            front += near
        expected |= dict.fromkeys(group, min(group)) if len(group) > 1 else {}
    assert found == expected


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (7, 7), (None, 3)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(df).collect()}
    assert found == {**dict.fromkeys(range(101), 0), 400: 400, 500: 400}


def test_components_of_a_hot_node(spark, monkeypatch):
    from functools import partial

    from stridecast.llm import components as module

    # Nothing broadcast, and a node of more than 20 links is split.
    monkeypatch.setattr(module, "attach", partial(module.attach, broadcast_bytes=-1, rows_per_task=20))
    hub = [(3, i) for i in range(10, 400)] + [(i, i + 1) for i in range(1000, 1005)] + [(1003, 1005)]
    found = {r["node"]: r["root"] for r in module.components(spark.createDataFrame(hub, "a bigint, b bigint")).collect()}
    assert found == {3: 3, **dict.fromkeys(range(10, 400), 3), **dict.fromkeys(range(1000, 1006), 1000)}


def test_substrings(docs, cases):
    assert by_id(substring.substring_dedup(docs), "n_words", "n_removed", "kept_sha256") == brute.repeats(cases)


def test_substrings_in_split_shards(docs, cases, monkeypatch):
    monkeypatch.setattr(substring, "PIECES", 2)
    monkeypatch.setattr(substring, "PHRASES", 3)
    monkeypatch.setattr(substring, "PIECE_BYTES", 500)
    assert by_id(substring.substring_dedup(docs), "n_words", "n_removed", "kept_sha256") == brute.repeats(cases)


def test_substrings_with_null_and_repeated_ids(spark):
    text = prose(4, 70)
    df = spark.createDataFrame([(None, text), (2, text), (2, text), (3, text + " more")], "doc_id bigint, text string")
    out = sorted((r["doc_id"] or -1, r["n_removed"]) for r in substring.substring_dedup(df).collect())
    assert out == [(-1, 0), (2, 0), (2, 0), (3, 70)]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def test_packing_round_trip(docs, cases):
    pieces = packing.packed(docs, default_tokenizer()).collect()
    assert brute.check_packing(cases, pieces, tokenizer())[0] == 0
    ids = {r["doc_id"]: r for r in pieces if r["start"] == 0}
    assert ids[5]["ids"] == [2] and ids[5]["doc_tokens"] == 1


def test_packer_flushes_when_many_are_open():
    packer = packing.Packer(capacity=64, most_open=4)
    draw = random.Random(3)
    sizes = [draw.choice([33, 40, 50, 1, 130]) for _ in range(300)]
    pieces = [p for d, n in enumerate(sizes) for p in packer.add(d, np.full(n, d, "<u4"))] + list(packer.flush())
    assert packer.n_open == 0
    for d, n in enumerate(sizes):
        own = sorted((start, len(ids)) for doc, start, ids, *_ in pieces if doc == d)
        assert [s for s, _ in own] == [sum(k for _, k in own[:i]) for i in range(len(own))] and sum(k for _, k in own) == n


def test_forgetting_words_changes_no_ids(cases, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    encode, own = packing.WordIds(default_tokenizer()), tokenizer()
    for _, text in cases:
        ids = np.frombuffer(encode((text or "").encode()), "<u4").tolist()
        assert ids == own.encode(text or "", add_special_tokens=False).ids


def test_shards(docs, cases):
    brute.check_shards(cases, sharding.sharded(docs).collect())


def test_shares_follow_weights(spark):
    tree = {0: {0: {0: 1.0, 1: 1.0}}, 1: {0: {2: 1.0}, 1: {3: 1.0}}}
    heavier = {0: {0: {0: 1.0, 1: 3.0}}, 1: {0: {2: 1.0}, 1: {3: 1.0}}}
    df = sharding.shard_of(sharding.shard_of(spark.range(20_000), "id", tree, "a"), "id", heavier, "b")
    counts = {(r["a"], r["b"]): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert all(abs(sum(n for (a, _), n in counts.items() if a == s) - 5000) < 300 for s in range(4))
    # Nothing moves into or within the region whose weight stays.
    assert not any(b in (2, 3) and a != b for a, b in counts)


def test_mixing_reaches_targets(spark, docs, cases):
    out = mixing.mix_report(docs).collect()
    assert len(out) == len(cases)
    sizes = {d: len(brute.words(t)) for d, t in cases}
    total = sum(sizes.values())
    targets = {(r["source_size"], r["target"]) for r in out}
    assert all(r["size"] == sizes[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"]) for r in out)
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total) and all(t <= 2 * s for s, t in targets)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(copies.get(r["doc_id"], 0) * r["size"] == r["taken"] for r in out if r["size"])


def test_fingerprints(docs, cases):
    out = {r["doc_id"]: r for r in omh.fingerprinted(docs).collect()}
    texts = [t or "" for _, t in cases]
    for k, (doc_id, _) in enumerate(cases):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        changed = omh.edited(text, following)
        r = out[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        own, other, after = omh.sketch_of([text, changed, following])
        assert r["fingerprint"] == own.astype(">u2").tobytes().hex()
        assert r["near_edited"] == (own == other).mean() and r["near_next"] == (own == after).mean()


def test_fingerprint_picks_the_smallest_in_text_order():
    words = prose(11, 40_000).split()
    (texts,) = texts_of(pa.array([" ".join(words)]))
    kmers, _ = omh._kmers(texts)
    expected = np.sort((kmers * omh._MULTIPLIERS[5]).argsort()[: omh.PICKED])
    assert omh._smallest(kmers)[5].tolist() == expected.tolist()
    a, b = omh.sketch_of([" ".join(words[:400]), " ".join(words[200:400] + words[:200])])
    assert 0.2 < (a == b).mean() < 0.9  # the same words in another order are not the same


def test_fingerprints_follow_edits_without_white_space():
    draw = random.Random(3)
    text = "".join(chr(0x4E00 + draw.randrange(2_000)) for _ in range(1_000))
    some = text[:500] + "\u3002" + text[510:]
    other = "".join(chr(0x4E00 + draw.randrange(2_000)) for _ in range(1_000))
    own, near, far, *mixed = omh.sketch_of([text, some, other, "a b " + text, "a b", "a b c" * 10])
    assert (own == near).mean() > 0.8 and (own == far).mean() < 0.1 and (own == mixed[0]).mean() > 0.8
    (texts,) = texts_of(pa.array(["ab " + "x\u00fc" * 20 + " c", "", "y" * 49, "y" * 48]))
    assert omh._units(texts)[1].tolist() == [0, 42, 42, 91, 92]


def test_licenses(docs):
    out = license.licenses(docs).collect()
    assert [(r["license"], r["containment"], r["first_word"], r["last_word"]) for r in out] == [("mit-line", 1.0, 0, 4)]


def test_licenses_equal_brute_force(given):
    prepared = license.Templates(license.TEMPLATES)
    for _, text in given:
        (t,) = texts_of(pa.array([text or ""]))
        own = license.shingles(license.folded(t))[0]
        inside = set(own.tolist())
        expected = {
            i
            for i, s in enumerate(prepared.shingles)
            if len(inside.intersection(s.tolist())) >= license.LIKENESS * len(s)
        }
        assert set(prepared.matches(own)) == expected


def test_short_notices(spark):
    lines = ["All rights reserved.", "SPDX-License-Identifier: MIT", "Released under the MIT License."]
    texts = [prose(2, 9) + "\n" + a for a in lines]
    texts += ["(c) 2020 ALL RIGHTS RESERVED; all rights reserved", "// SPDX-License-Identifier: X-1", "all rights", "All rights\tare reserved"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted(tuple(r) for r in license.licenses(df).collect())
    assert found == [
        (0, "all-rights-reserved-line", 1.0, 9, 11),
        (1, "spdx-mit", 1.0, 9, 10),
        (1, "spdx-tag", 1.0, 9, 9),
        (2, "mit-line", 1.0, 9, 13),
        (3, "all-rights-reserved-line", 1.0, 2, 4),
        (4, "spdx-tag", 1.0, 0, 0),
    ]


def test_given_notice_lines_are_found(spark, given):
    notice = re.compile(r"licensed under|released under|rights reserved|spdx-license", re.IGNORECASE)
    wanted = {d for d, t in given if t and notice.search(t.split("\n")[-1])}
    found = {r["doc_id"] for r in license.licenses(spark.createDataFrame(given, "doc_id bigint, text string")).collect()}
    assert wanted and wanted <= found


def test_languages(spark, docs, cases):
    out = by_id(langid.predict(docs, langid.fit(docs)), "lang_pred", "score")
    assert {out[d][0] for d, t in cases if any(c.isalpha() for c in t or "")} == {"en"}
    assert all(out[d] == ("und", 0.0) for d, t in cases if not any(c.isalpha() for c in t or ""))
    none = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert set(by_id(langid.predict(docs, none), "lang_pred").values()) == {("und",)}


def test_filters_name_every_language_of_an_ngram():
    grams, _ = langid.grams_of(["bonjour le monde"])
    masks = np.zeros((1, langid.SLOTS), np.uint64)
    for slot in langid._slots(grams):
        masks[0, slot.astype(np.int64)] |= np.uint64(2)
    filters = langid.Filters(["de", "fr"], masks, "de")
    total, hits = filters.hits(["monde", "", "1"])
    assert total.tolist() == [9, 0, 0] and hits.tolist() == [[0, 9], [0, 0], [0, 0]]


def test_held_out_accuracy(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op2_language"](spark, SF_DIR).where("held_out").join(truth, "doc_id").where("lang is not null")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count() > 0
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = QUERIES["op7_quality"](spark, SF_DIR).where("held_out").join(labels, "doc_id")
    assert judged.where("quality = predicted").count() >= 0.85 * judged.count() > 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    bounds = np.array([0, 1, 5, 8])
    unary, t = rng.normal(size=8), rng.normal(size=(2, 2))
    forward, backward = quality.messages(unary, bounds, t)
    found = 1 / (1 + np.exp(-(forward + backward)))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        weight, good = 0.0, np.zeros(b - a)
        for state in np.ndindex(*(2,) * (b - a)):
            w = np.exp(sum(u * s for u, s in zip(unary[a:b], state, strict=True)) + sum(t[x, y] for x, y in zip(state, state[1:])))
            weight += w
            good += w * np.array(state)
        assert found[a:b] == pytest.approx(good / weight)


def test_messages_of_long_texts(monkeypatch):
    rng = np.random.default_rng(6)
    bounds = np.cumsum([0, 1, 7, 4, 29, 8, 12, 3])
    unary, t = rng.normal(size=bounds[-1]), rng.normal(size=(2, 2))
    whole = quality.messages(unary, bounds, t)
    monkeypatch.setattr(quality, "PIECE", 4)
    assert np.allclose(whole, quality.messages(unary, bounds, t))
    monkeypatch.undo()
    steps, step = [], quality._step
    monkeypatch.setattr(quality, "_step", lambda *a: steps.append(1) or step(*a))
    quality.messages(rng.normal(size=100_000), np.array([0, 100_000]), t)
    assert len(steps) < 5_000


def test_the_fit_is_bounded_in_lines(spark, monkeypatch):
    texts = ["a b\n" * 5 + prose(i, 5) for i in range(40)] + ["x\n" * 5_000]
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][: len(texts)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id bigint, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda f, n, bounds, y: seen.append(np.diff(bounds).tolist()))
    for most in (6_000, 100, 3):
        monkeypatch.setattr(quality, "SAMPLE_LINES", most)
        quality.fit(docs, labels)
    assert seen == [[6] * 40 + [5_001], [6] * 16, [6]]


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.accepted(docs, none).columns == docs.columns


def test_lines_belong_to_their_texts():
    (texts,) = texts_of(pa.array(["a\n\nb\n", "", "c"]))
    features, length, bounds = quality.line_features(texts)
    assert bounds.tolist() == [0, 4, 5, 6] and length.tolist() == [2, 1, 2, 1, 1, 1] and len(features) == 6


EMPTY = [
    exact_dedup.exact_groups, exact_dedup.distinct_texts, simhash.near_duplicate_groups, simhash.representatives,
    substring.substring_dedup, sharding.sharded, mixing.mix_report, mixing.mixed, omh.fingerprinted, license.licenses,
    lambda d: packing.packed(d, default_tokenizer()), lambda d: langid.predict(d, langid.fit(d)),
]


@pytest.mark.parametrize("operator", EMPTY)
def test_empty_tables(docs, operator):
    assert operator(docs.limit(0)).collect() == []


def test_representatives(docs, cases):
    kept = {r["doc_id"] for r in simhash.representatives(docs).collect()}
    assert kept == {c for _, c in brute.near(cases).values()}


def test_given_tables(spark, given):
    got = {name: QUERIES[name](spark, SF_DIR).collect() for name in ("op4_packing", "op5_simhash", "op8_substring", "op9_sharding")}
    assert brute.check_packing(given, got["op4_packing"], tokenizer())[0] == 0
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got["op5_simhash"]} == brute.near(given)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got["op8_substring"]} == brute.repeats(given)
    brute.check_shards(given, got["op9_sharding"])


def test_pipeline_stages(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF_DIR).cache()
    judged = {r["doc_id"]: r["predicted"] for r in QUERIES["op7_quality"](spark, SF_DIR).collect()}
    assert {r["doc_id"] for r in good.collect()} == {d for d, p in judged.items() if p}
    distinct = stages["exact dedup"](spark, good, SF_DIR).cache()
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert {r["doc_id"] for r in distinct.collect()} == {d for d, r in brute.exact(rows).items() if r[2]}
    unlike = stages["simhash near-dedup"](spark, distinct, SF_DIR).cache()
    rows = [(r["doc_id"], r["text"]) for r in distinct.collect()]
    assert {r["doc_id"] for r in unlike.collect()} == {c for _, c in brute.near(rows).values()}
    mixed = stages["mixing"](spark, unlike, SF_DIR).cache()
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_report(unlike).collect()}
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(brute.words(r["text"]))
    assert words == {d: n for d, n in taken.items() if n}
    assert all(f.columns == docs.columns for f in (good, distinct, unlike, mixed))
    pieces = stages["packing"](spark, mixed, SF_DIR)
    assert pieces.agg(F.sum("length")).first()[0] == mixed.select("text").rdd.map(
        lambda r: len(packing.word_ids(default_tokenizer())((r["text"] or "").encode())) // 4 + 1
    ).sum()


CASED = "doc_id bigint, text string, lang string, source string, n_chars bigint, Quality_Score string, SCORE int, Doc string, ROW int, Digest string, Fingerprint int, Key int, Sequence_ID int, Held_Out int"


@pytest.mark.parametrize("step", [stage for _, stage in corpus_pipeline.STAGES])
def test_stages_with_names_that_differ_in_case(spark, cases, step, tmp_path):
    rows = [(i, t, "en", "s", None, "x", 1, "y", 2, "z", 3, 4, 5, 6) for i, t in cases]
    rows += [rows[3], (None, *rows[9][1:]), (None, None, None, None, None, *rows[0][5:])]
    spark.createDataFrame([(rows[i][0], i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, CASED).repartition(3)
    out = step(spark, docs, str(tmp_path))
    assert out.count() > 0
    if step is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns and {tuple(r[5:]) for r in out.collect()} == {tuple(rows[0][5:])}
    assert step(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_a_score_column_is_replaced(spark, docs):
    out = quality.with_quality(docs.withColumn("Score", F.lit("x")), None, score="score")
    assert out.columns == [*docs.columns, "score"] and {r["score"] for r in out.collect()} == {0.5}
    labels = spark.createDataFrame([(5 + 3 * i, i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    field = quality.fit(docs, labels)
    out = quality.with_quality(docs.withColumn("Score", F.lit("x")), field, score="score")
    assert out.columns == [*docs.columns, "score"] and all(0 <= r["score"] <= 1 for r in out.collect())
