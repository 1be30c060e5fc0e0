"""The registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from plumbrow.llm.ball_tree import ranked_documents
from plumbrow.llm.chosen_path import near_sets
from plumbrow.llm.common import crc_of_id, documents, ship_package
from plumbrow.llm.decontaminate import contaminated, contamination, items_digest
from plumbrow.llm.digest import compared
from plumbrow.llm.kd_shards import kd_shards
from plumbrow.llm.language_model import scored
from plumbrow.llm.lines import deduplicated
from plumbrow.llm.mixture import packed
from plumbrow.llm.records import records_of
from plumbrow.llm.oracle_sql import SQL
from plumbrow.llm.simhash import hex_of, near_duplicates
from plumbrow.llm.suffixes import without_repeats
from plumbrow.llm.tokens import tokenizer_path
from plumbrow.llm.toxicity import self_judged
from plumbrow.llm.turns import repair_report

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = 2048


def _sha256(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def judged_documents(
    spark: SparkSession, docs: DataFrame, sf_dir: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """`self_judged` by the labels whose crc32(doc_id as text) mod 4 is not 2."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return self_judged(docs, labels, crc_of_id("doc_id") % 4 != 2, keep)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_documents(spark, documents(spark, sf_dir), sf_dir, ("doc_id",)).select(
        "doc.doc_id",
        (crc_of_id("doc.doc_id") % 4 == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "threshold",
        "rejected",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)
    return grouped.select("doc.doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(documents(spark, sf_dir), benchmark, window=13)
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        items_digest().alias("items_sha256"),
        contaminated(hit_in=20).alias("contaminated"),
    )


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicated(documents(spark, sf_dir), least=10)
    return kept.select(
        "doc.doc_id", "n_lines", "n_dropped", _sha256("kept_text").alias("kept_sha256")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir), shards=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), tokenizer_path(), end_id=1, length=WINDOW)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_of_id("doc_id") % 7 == 2
    found = scored(documents(spark, sf_dir), training=~held_out)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(documents(spark, sf_dir), window=13)
    return kept.select(
        "doc.doc_id", "n_words", "n_removed", _sha256("kept_text").alias("kept_sha256")
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(documents(spark, sf_dir))


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(documents(spark, sf_dir), tokenizer_path(), end_id=2)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked_documents(documents(spark, sf_dir), benchmark, k=10)


def op12_near_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets(documents(spark, sf_dir), percent=80, length=2)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_lines": op2_lines,
    "op3_sharding": op3_sharding,
    "op4_packing": op4_packing,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_language_model": op7_language_model,
    "op8_substrings": op8_substrings,
    "op9_fingerprints": op9_fingerprints,
    "op10_records": op10_records,
    "op11_search": op11_search,
    "op12_near_sets": op12_near_sets,
    "op13_conversations": op13_conversations,
}

QUERIES: dict[str, Query] = {name: _shipped(query) for name, query in _QUERIES.items()}

__all__ = ["QUERIES", "SQL"]
