"""A training corpus from ``documents``: language, quality, near duplicates, mix, packed sequences.

Every stage takes null ids, texts and languages, empty and very long texts, repeated rows and empty
tables. Rows count one by one, also those with a null or shared id. Further columns are passed on
by all stages but the last. Stages that run Python ask for small batches, so a worker's memory
follows the longest texts and not the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from excursio.llm import chosenpath, langid, mixing, packing, quality, workers
from excursio.shared import write_shared


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without letters (null and empty texts too) or in no learned language."""
    workers.small_batches(spark)
    return langid.accepted(docs)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that the scorer trained on weak labels takes for bad; equal texts fare alike."""
    workers.small_batches(spark)
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, the one with the least id (or one without, if none has)."""
    workers.small_batches(spark)
    return chosenpath.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and select documents so that the words of each source meet its budget; a null source is a source."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise the documents and pack them into sequences; one row for each piece, at least one a document."""
    workers.small_batches(spark)
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: Training, joins and packing aren't expressible in SQL; the stages are tested one by one.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
