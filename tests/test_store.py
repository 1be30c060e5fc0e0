"""Storing findings, run history and reading them back."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from plumbrow.plans.findings import (
    HISTORY_TABLE,
    all_findings,
    run_check,
    status_of,
    store_findings,
    stored_findings,
)
from plumbrow.plans.registry import Check, find_check, select_checks
from plumbrow.schema import ALL_FINDINGS_SCHEMA
from plumbrow.settings import Settings
from plumbrow.sources import staging
from plumbrow.sources.samples import sample_mart
from plumbrow.sources.tables import TableRef, mart_ref, read_table, write_table

SF_DIR = "/root/testdata/sf0.001"
SETTINGS = Settings(min_disclosure_year=1995)


@pytest.fixture
def place(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dq")
    yield TableRef("edb_mart", "dq")
    spark.sql("DROP DATABASE dq CASCADE")


def test_names():
    assert mart_ref("edb").name == "`edb`.`edb_mart`"
    assert mart_ref("edb", "marts", "lake").name == "`lake`.`marts`.`edb_mart`"
    with pytest.raises(ValueError, match="no check"):
        find_check("nothing")
    assert [c.name for c in select_checks(tags=("informational",))] == ["units_across_years"]
    assert [status_of("error", 1), status_of("warn", 1), status_of("error", 0)] == [
        "fail",
        "warn",
        "pass",
    ]


def test_nothing_stored_yet(spark, place):
    empty = stored_findings(spark, ["edb"], place)
    assert empty.schema == ALL_FINDINGS_SCHEMA and empty.isEmpty()


def test_partial_runs_and_history(spark, place):
    mart = sample_mart(spark, SF_DIR)
    write_table(mart, place)
    stored_mart = read_table(spark, place)
    first = select_checks(("duplicate_rows", "ambiguous_rows"))
    statuses = store_findings(stored_mart, "edb", place, SETTINGS, first).collect()
    assert {(r.test_name, r.status, r.n_findings > 0) for r in statuses} == {
        ("edb_dq_duplicate_rows", "warn", True),
        ("edb_dq_ambiguous_rows", "fail", True),
    }
    assert {r.test_name for r in stored_findings(spark, ["edb"], place).collect()} == {
        "edb_dq_duplicate_rows",
        "edb_dq_ambiguous_rows",
    }
    store_findings(stored_mart, "edb", place, SETTINGS, select_checks(("sign_flip",)))
    history = read_table(spark, place.beside(HISTORY_TABLE))
    assert history.count() == 3 and history.select("run_id").distinct().count() == 2

    found = stored_findings(spark, ["edb"], place).collect()
    names = ["duplicate_rows", "ambiguous_rows", "sign_flip"]
    direct = all_findings(mart, "edb", SETTINGS, select_checks(names)).collect()
    assert sorted(map(str, found)) == sorted(map(str, direct))
    assert [r.check_name for r in found] == sorted(r.check_name for r in found)
    own = read_table(spark, place.beside("edb_dq_sign_flip"))
    assert own.columns == run_check(find_check("sign_flip"), mart, "edb", SETTINGS).columns


def test_a_later_run_replaces_findings(spark, place):
    mart = sample_mart(spark, SF_DIR)
    checks = select_checks(("units_are_units",))
    store_findings(mart, "edb", place, SETTINGS, checks)
    store_findings(mart.where("units <> 'PROMO'"), "edb", place, SETTINGS, checks)
    items = [r.item for r in stored_findings(spark, ["edb"], place).collect()]
    assert "PROMO" not in items


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "staged"))
    assert staging.stage(spark.range(3), "numbers").count() == 3
    assert list((tmp_path / "staged").iterdir())
    staging.drop_staged(spark)
    assert not (tmp_path / "staged").exists()


def staged(spark):
    root = staging.staging_root(spark)
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_storing_leaves_nothing_staged(spark, place):
    mart = sample_mart(spark, SF_DIR)
    before = staged(spark)
    store_findings(mart, "edb", place, SETTINGS, select_checks(("duplicate_rows", "scale_break")))
    assert staged(spark) == before
    assert not stored_findings(spark, ["edb"], place).isEmpty()


def test_a_check_that_breaks_is_in_the_history(spark, place):
    def broken(rows, settings):
        raise RuntimeError("no such luck")

    checks = [find_check("duplicate_rows"), Check("broken", ("rows",), broken)]
    with pytest.raises(RuntimeError, match="no such luck"):
        store_findings(sample_mart(spark, SF_DIR), "edb", place, SETTINGS, checks)
    history = read_table(spark, place.beside(HISTORY_TABLE)).collect()
    assert {(r["check_name"], r["status"]) for r in history} == {
        ("duplicate_rows", "warn"),
        ("broken", "error"),
    }
    assert [r["n_findings"] for r in history if r["check_name"] == "broken"] == [None]


def numbers(n, broken=False):
    """A check that finds n rows, or fails in a task when they are written."""

    def find(rows, settings):
        found = rows.sparkSession.range(n).select(F.col("id").cast("string").alias("uid"))
        if broken:
            return found.withColumn("uid", F.when(F.col("uid") == "1", F.raise_error(F.lit("broken off"))).otherwise("x"))
        return found.select(
            F.lit("numbers").alias("check_name"),
            *[F.lit(None).cast("string").alias(c) for c in ("sector", "company", "schedule", "item")],
            F.lit(None).cast("int").alias("disclosure_year"),
            "uid",
        )

    return Check("numbers", ("rows",), find)


def test_findings_outlive_a_run_that_fails_while_writing(spark, place):
    mart = sample_mart(spark, SF_DIR)
    table = place.beside("edb_dq_numbers")
    store_findings(mart, "edb", place, SETTINGS, [numbers(5)])
    with pytest.raises(Exception, match="broken off"):
        store_findings(mart, "edb", place, SETTINGS, [numbers(9, broken=True)])
    assert read_table(spark, table).count() == 5
    store_findings(mart, "edb", place, SETTINGS, [numbers(7)])
    assert read_table(spark, table).count() == 7
    history = read_table(spark, place.beside(HISTORY_TABLE)).orderBy("run_at").collect()
    assert [(r["n_findings"], r["status"]) for r in history] == [(5, "warn"), (None, "error"), (7, "warn")]


def versions(spark, ref):
    folder = spark.catalog.getDatabase(ref.schema).locationUri.removeprefix("file:")
    return sorted(f for f in os.listdir(folder) if f.startswith(ref.identifier))


def test_a_table_is_replaced_by_repointing_it(spark, place):
    table = place.beside("numbers")
    write_table(spark.range(3), table)
    reader = read_table(spark, table)
    write_table(read_table(spark, table).where("id > 0"), table)  # from itself
    assert reader.count() == 3  # the former version stays for those who read it
    assert read_table(spark, table).count() == 2
    write_table(spark.range(8), table)
    assert len(versions(spark, table)) == 2 and read_table(spark, table).count() == 8
    with pytest.raises(Exception, match="no good"):
        write_table(spark.range(4).select(F.raise_error(F.lit("no good")).cast("long").alias("id")), table)
    assert len(versions(spark, table)) == 2 and read_table(spark, table).count() == 8
    write_table(spark.range(2).withColumn("more", F.lit("x")), table)
    assert read_table(spark, table).columns == ["id", "more"] and read_table(spark, table).count() == 2


@pytest.mark.parametrize("master, needs", [("local[4]", False), ("local", False), ("yarn", True),
                                           ("local-cluster[2,1,1024]", True)])
def test_a_cluster_needs_a_shared_folder(master, needs):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: None
    )
    conf = SimpleNamespace(get=lambda key, default: None)
    session = SimpleNamespace(sparkContext=context, conf=conf)
    if needs:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging.staging_root(session)
    else:
        assert staging.staging_root(session) == staging.staging_root(session)
