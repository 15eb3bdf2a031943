"""The operators' queries: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from visitlens.llm import langid, licenses, lmscore, mixing, neardup, packing, quality, secrets, simhash, urlfilter, variants, veccodes, warc
from visitlens.llm.common import table


def tokenizer_path() -> str:
    """The production tokenizer's file, where the installed package keeps it."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.secret_spans(docs))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rule_table(spark)).drop("url")


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(table(spark, sf_dir, "documents"))


def op7_simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_links(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(table(spark, sf_dir, "documents"))


def op8_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veccodes.code_report(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_pack, op2_secrets, op3_mix, op4_url_filter, op5_neardup, op6_lm_score, op7_simhash, op7_simhash_links,
             op8_license, op9_langid, op10_quality, op11_vector_codes, op12_warc, op13_variants)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_secrets": secrets.digest_sql(), "op4_url_filter": urlfilter.judge_sql(),
            "op11_vector_codes": veccodes.report_sql(), "op12_warc": warc.report_sql()}
