"""Every pipeline stage against brute force over what its predecessor kept, and the whole run."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from plumbrow.llm.common import stage
from plumbrow.llm.queries import QUERIES
from tests.llm.fixtures import awkward_rows, table
from tests.llm.test_text_operators import (
    contamination_by_force,
    groups_by_force,
    lines_by_force,
)
from tests.llm.test_token_operators import crc, ids_of, tokenizer  # noqa: F401

SF = "/root/testdata/sf0.01"
FUNCTIONS = dict(corpus_pipeline.STAGES)


def as_rows(docs):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


def ordered(values):
    return sorted(values, key=repr)


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returned on the sample, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name.replace(" ", "-"))
        out[name] = docs
    return out


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "line dedup",
        "near-duplicates",
        "decontamination",
        "packing",
    ]
    assert queries()["pipeline"] is corpus_pipeline.run


def test_columns_stay(steps):
    columns = steps["documents"].schema.simpleString()
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name].schema.simpleString() == columns


def test_rejected_documents_go_and_clean_ones_stay(spark, steps):
    scores = QUERIES["op1_toxicity"](spark, SF)
    kept = {r["doc_id"] for r in scores.filter(~F.col("rejected")).collect()}
    assert {r["doc_id"] for r in steps["toxicity"].select("doc_id").collect()} == kept
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, y in labels.items() if not y]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    toxic = [i for i, y in labels.items() if y]
    assert sum(i not in kept for i in toxic) >= 0.8 * len(toxic)


def test_lines(steps):
    expected = [(i, text) for i, _, _, text in lines_by_force(as_rows(steps["toxicity"]))]
    found = steps["line dedup"].select("doc_id", "text", "n_chars").collect()
    assert ordered((r["doc_id"], r["text"]) for r in found) == ordered(expected)
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_one_document_of_each_group_stays(steps):
    expected = groups_by_force(as_rows(steps["line dedup"]))[1]
    found = [r["doc_id"] for r in steps["near-duplicates"].select("doc_id").collect()]
    assert ordered(found) == ordered(expected)


def test_contaminated_documents_go(spark, steps):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    before = as_rows(steps["near-duplicates"])
    judged = contamination_by_force(before, [tuple(i) for i in items])
    expected = [i for i, *_, contaminated in judged if not contaminated]
    found = [r["doc_id"] for r in steps["decontamination"].select("doc_id").collect()]
    assert ordered(found) == ordered(expected) and len(found) < len(before)


def test_all_tokens_are_packed(steps, tokenizer):  # noqa: F811
    expected = {i: ids_of(tokenizer, t, 1) for i, t, *_ in as_rows(steps["decontamination"])}
    found = steps["packing"].collect()
    at = Counter()
    for p in sorted(found, key=lambda p: (p["doc_id"], p["start"])):
        ids = expected[p["doc_id"]]
        assert (p["start"], p["doc_tokens"]) == (at[p["doc_id"]], len(ids))
        assert p["ids_crc32"] == crc(ids[p["start"] : p["start"] + p["length"]])
        at[p["doc_id"]] += p["length"]
    assert at == {i: len(ids) for i, ids in expected.items()}


def test_run_is_the_stages_in_turn(spark, steps):
    found = corpus_pipeline.run(spark, SF)
    same = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = lambda df: df.agg(F.sum("length"), F.count_distinct("doc_id")).first()
    assert total(found) == total(steps["packing"])
    assert set(same) <= set(found.columns)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_and_empty_tables(spark, name):
    awkward = table(spark, awkward_rows())
    found = FUNCTIONS[name](spark, awkward, SF)
    if name == "packing":
        assert found.select("doc_id").distinct().count() == awkward.select("doc_id").distinct().count()
    else:
        assert found.columns == awkward.columns
        assert found.count() > 10
    assert FUNCTIONS[name](spark, table(spark, []), SF).collect() == []


def test_one_row_of_repeated_rows_stays(spark):
    rows = [(1, "some words that are here", "en", "a")] * 3 + [(2, "other words stand over there", "en", "a")]
    kept = FUNCTIONS["near-duplicates"](spark, table(spark, rows), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2]
    assert zlib.crc32(kept[0]["text"].encode())
