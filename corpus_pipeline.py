"""The corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents, whatever further
columns these have; NULLs, empty tables and repeated rows go through as the operators define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrow.llm.common import documents, ship_package, stage
from plumbrow.llm.decontaminate import contaminated, contamination
from plumbrow.llm.lines import deduplicated
from plumbrow.llm.mixture import packed
from plumbrow.llm.queries import judged_documents
from plumbrow.llm.simhash import first_of_each, near_duplicates
from plumbrow.llm.tokens import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity reaches their language's threshold."""
    ship_package(spark)
    return judged_documents(spark, docs, sf_dir).filter(~F.col("rejected")).select("doc.*")


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep lines that several documents hold in one of them only; n_chars follows the text."""
    ship_package(spark)
    kept = deduplicated(docs, least=10)
    columns = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("text", "n_chars")]
    columns.append(F.col("kept_text").alias("text"))
    if "n_chars" in docs.columns:
        n_chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        columns.append(n_chars.alias("n_chars"))
    return kept.select(*columns).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_copies_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each near-duplicate group the document with the smallest doc_id."""
    ship_package(spark)
    return first_of_each(near_duplicates(docs, shingle=4, distance=4))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth of the words or more are benchmark passages."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(docs, benchmark, window=13)
    return found.filter(~contaminated(hit_in=20)).select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, the sources mixed as they are in the corpus."""
    ship_package(spark)
    return packed(docs, tokenizer_path(), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("line dedup", lines_once),
    ("near-duplicates", near_copies_once),
    ("decontamination", decontaminated),
    ("packing", packing),
]

#: The stages train and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
