"""The queries of this subpackage: ``opN_<name>`` over its whole table, and the
DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekmart.llm import (
    decontaminate, licenses, mixing, pii, quality_rules, secrets_crf, simhash, spelling,
    substring_dedup, token_archive, url_rules, vector_codes, warc,
)
from weekmart.llm import oracle_sql as O
from weekmart.llm.text import table
from weekmart.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


@register("op1_warc")
def q_warc(spark, sf):
    return warc.warc_report(table(spark, sf, "pages"), scratch_dir(spark, "warc"))


@register("op2_simhash")
def q_simhash(spark, sf):
    return simhash.simhash_report(table(spark, sf, "documents"))


@register("op3_licenses")
def q_licenses(spark, sf):
    return licenses.license_report(table(spark, sf, "documents"))


@register("op4_secrets")
def q_secrets(spark, sf):
    return secrets_crf.secret_report(table(spark, sf, "documents"))


@register("op5_url_rules")
def q_urls(spark, sf):
    return url_rules.judge_urls(table(spark, sf, "pages"), table(spark, sf, "labels"))


@register("op6_mixing")
def q_mixing(spark, sf):
    return mixing.mixing_report(table(spark, sf, "documents"))


@register("op7_decontaminate")
def q_decontaminate(spark, sf):
    return decontaminate.contamination_report(table(spark, sf, "documents"),
                                              table(spark, sf, "benchmark"))


@register("op8_pii")
def q_pii(spark, sf):
    return pii.pii_report(table(spark, sf, "documents"))


@register("op9_quality_rules", O.QUALITY)
def q_quality(spark, sf):
    return quality_rules.quality_report(table(spark, sf, "documents"))


@register("op10_substring_dedup")
def q_substring(spark, sf):
    return substring_dedup.substring_report(table(spark, sf, "documents"))


@register("op11_token_archive")
def q_tokens(spark, sf):
    import public_tokenizers
    return token_archive.token_report(table(spark, sf, "documents"), scratch_dir(spark, "tokens"),
                                      public_tokenizers.path("byte_bpe_50k.json"), 2)


@register("op12_vector_codes")
def q_vectors(spark, sf):
    return vector_codes.code_report(table(spark, sf, "embeddings"))


@register("op13_spelling")
def q_spelling(spark, sf):
    return spelling.spelling_report(table(spark, sf, "documents"))
