"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.llm import (
    bpe,
    chosenpath,
    editcount,
    fingerprint,
    impact,
    langid,
    mixing,
    packing,
    prefixtree,
    quality,
    resample,
    sharding,
    sitestyle,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.drop("lang"), langid.learn(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "language.*")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitestyle.extract(_table(spark, sf_dir, "pages"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.learn(docs))
    return judged.select("doc_id", "quality.*", (F.col("quality.score") >= quality.LEAST).alias("accepted"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosenpath.near_duplicates(docs).select("doc_id", "class_id", "links", "copies", "kept")


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return impact.best_matches(vectors, F.col("vec_id") % 50 == 0, k=5)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(_table(spark, sf_dir, "documents"), shards=8)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    edits = editcount.drawn_edits(F.col("text"), F.col("doc_id"))
    return editcount.count_edited(docs, edits).select("doc_id", "counts.*")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtree.prefix_tree(_table(spark, sf_dir, "conversations"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_html_extraction": op2_html_extraction,
        "op3_fingerprint": op3_fingerprint,
        "op4_quality": op4_quality,
        "op5_ngram_join": op5_ngram_join,
        "op6_topk_search": op6_topk_search,
        "op7_mixing": op7_mixing,
        "op8_sharding": op8_sharding,
        "op9_packing": op9_packing,
        "op10_token_counts": op10_token_counts,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_importance_resampling": op12_importance_resampling,
        "op13_bpe": op13_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_topk_search": impact.SQL,
        "op7_mixing": mixing.SQL,
        "op11_prefix_trie": prefixtree.SQL,
        "op12_importance_resampling": resample.SQL,
    }
