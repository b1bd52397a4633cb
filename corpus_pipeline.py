"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
and reads it again as the next one's docs. All but the last return the columns of documents.

A document is rejected in the first stage where its text has no language, letters of several
in equal parts, or letters that no learned language would have. Exact copies keep the largest doc_id, near copies the
least one of each linked group, and one row of each where ids repeat or are null; the mix repeats a document as often as it takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from volspark.llm import bpe, exact, langid, mixing, simhash
from volspark.sinks import clearing_scratch, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    return langid.with_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.one_of_each_text(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each_component(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return bpe.encoded(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: The stages learn a model and encode; SQL has neither. Tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over documents; only what the last one wrote stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result = scratch_path(spark, "corpus")
    with clearing_scratch(spark):
        for stage, function in STAGES:
            final = function is STAGES[-1][1]
            path = result if final else scratch_path(spark, f"corpus-{stage}")
            with clearing_scratch(spark):
                function(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
