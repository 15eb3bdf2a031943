"""The corpus pipeline: from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next one's ``docs``; all but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import langid, mixing, neardup, packing, secrets
from visitlens.llm.common import arrow_rows, stage
from visitlens.llm.queries import tokenizer_path
from visitlens.session import configure

#: words of a shingle by which the near-duplicate stage compares texts
SHINGLE = 5
#: SQL cannot express the character models and the signatures
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; a text that is null, has
    no letter, or lies beyond every model's limits goes."""
    arrow_rows(spark)
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), docs["text"])
    return langid.identify(rows, langid.train(docs), ["_doc"]).where("not rejected").select("_doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates, that of the least doc_id. Texts
    are alike that share 80 % of their runs of ``SHINGLE`` words. Decided
    by row, so a text that shares its id with a copy stays, and of equal rows one
    stays. Rows whose text is null, empty or blank all stay."""
    return neardup.one_of_each(docs, shingle=SHINGLE)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; a null text stays null,
    equal rows stay equal, an empty table stays empty."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mixture of the sources takes them: some left out,
    some repeated, the last of a source cut at a word. A null or empty text has no
    words and is not taken; a null source is one of its own."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a null or empty text is its end mark
    alone."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
