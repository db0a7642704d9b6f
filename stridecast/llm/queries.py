"""One query per operator, over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stridecast.llm import (
    exact_dedup,
    fim,
    langid,
    license,
    mixing,
    omh,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    warc,
    whitening,
)
from stridecast.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_license(spark, sf_dir):
    return license.licenses(table(spark, sf_dir, "documents"))


@query
def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False)


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op6_fingerprints(spark, sf_dir):
    return omh.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op7_quality(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_substring(spark, sf_dir):
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


@query
def op9_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op11_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


@query
def op12_whitening(spark, sf_dir):
    return whitening.report(table(spark, sf_dir, "embeddings"))


@query
def op13_fim(spark, sf_dir):
    return fim.digests(table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_warc": warc.ORACLE,
    "op13_fim": fim.ORACLE,
}
