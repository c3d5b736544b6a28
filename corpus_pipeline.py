"""Corpus pipeline: documents through five operators of ``wardline.llm``, each stage stored as Parquet.

Every stage takes nulls in any column, empty and very long texts, repeated rows, an empty table and
further columns; all but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import decontaminate, mixing, neardup, tokens, toxicity
from wardline.llm.common import ship, store, work_folder
from wardline.llm.queries import train_toxicity

# Words of a shingle in the stage of near-duplicates.
SHINGLE = 5
# Words a worker remembers while it encodes; the workers of the earlier stages hold memory of their own.
MAX_WORDS = 500_000


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network, trained on the labels, does not reject.

    Null, empty and blank texts score 0 and stay; every row is judged by its own text, so repeated rows share a
    verdict. Without labelled documents of both classes there is nothing to learn and nothing is rejected.
    """
    ship(spark)
    return toxicity.drop_toxic(docs, train_toxicity(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: sets of five-word shingles with a similarity of 0.8 or more.

    Texts without words all stay, repeated rows become one, rows without id take part like any other.
    """
    ship(spark)
    return neardup.drop_near_duplicates(docs, size=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; null and empty texts hold none and stay."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources: every document as often as it is taken.

    Null sources are one source; texts without words have size 0 and are taken like others of their source.
    """
    ship(spark)
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and per row what the files hold; null and empty texts hold the end id alone."""
    import public_tokenizers

    ship(spark)
    path = work_folder(spark)
    tokens.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), max_words=MAX_WORDS)
    return tokens.read_token_files(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxic_documents", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("token_files", token_files),
]

# Neither training nor tokenizer can be written in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every one reads what the one before it stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
