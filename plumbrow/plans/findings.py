"""Running checks, storing what they find, and combining the findings."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbrow.operators.lists import first_parts
from plumbrow.plans.registry import (
    CHECKS,
    ERROR,
    JOBS_AT_ONCE,
    Check,
    CheckInputs,
    prepare,
    run_checks,
)
from plumbrow.schema import ALL_FINDINGS_SCHEMA
from plumbrow.settings import Settings
from plumbrow.sources.sectors import standard_rows
from plumbrow.sources.staging import in_same_scope, release_shuffles, staged_until_done
from plumbrow.sources.tables import TableRef, append_table, read_table, table_exists, write_table

HISTORY_TABLE = "dq_run_history"
FAILED = "error"
HISTORY_SCHEMA = (
    "run_id string, run_at timestamp, test_name string, check_name string, severity string, "
    "tags string, n_findings bigint, status string"
)


def run_check(
    check: Check, mart: DataFrame, sector: str, settings: Settings = Settings()
) -> DataFrame:
    """One check's findings, without storing anything; building them may run and stage jobs."""
    return check.run(CheckInputs(standard_rows(mart, sector, settings), settings))


def counting_findings(findings: DataFrame) -> tuple[DataFrame, Observation]:
    """The same findings, which count themselves when they are first written or collected."""
    counted = Observation()
    is_first = F.col("part") == 1 if "part" in findings.columns else F.lit(True)
    return findings.observe(counted, F.count_if(is_first).alias("n_findings")), counted


def _common(findings: DataFrame, check: Check, sector: str) -> DataFrame:
    return first_parts(findings).withColumns(
        {"test_name": F.lit(check.test_name(sector)), "severity": F.lit(check.severity)}
    ).select(*ALL_FINDINGS_SCHEMA.names)


def _combined(spark: SparkSession, parts: Sequence[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], ALL_FINDINGS_SCHEMA)
    return reduce(DataFrame.unionByName, parts).orderBy(
        "severity", "check_name", "sector", "company", "disclosure_year"
    )


def all_findings(
    mart: DataFrame,
    sector: str,
    settings: Settings = Settings(),
    checks: Sequence[Check] = CHECKS,
) -> DataFrame:
    """The findings of all checks in one table.

    Relations that several checks read are staged while the plan is built, which runs jobs.
    """
    inputs = CheckInputs(standard_rows(mart, sector, settings), settings, shared=True)
    found = run_checks(inputs, checks)
    parts = [_common(df, check, sector) for df, check in zip(found, checks, strict=True)]
    return _combined(mart.sparkSession, parts)


def status_of(severity: str, n_findings: int) -> str:
    if n_findings == 0:
        return "pass"
    return "fail" if severity == ERROR else "warn"


def check_statuses(
    findings: DataFrame, sector: str, checks: Sequence[Check] = CHECKS
) -> DataFrame:
    """How many findings each check has, and what that means at its severity."""
    listed = findings.sparkSession.createDataFrame(
        [(c.name, c.test_name(sector), c.severity) for c in checks],
        "check_name string, test_name string, severity string",
    )
    counts = findings.groupBy("check_name").agg(F.count("*").alias("_n"))
    n_findings = F.coalesce("_n", F.lit(0).cast("bigint"))
    status = F.when(n_findings == 0, "pass").when(F.col("severity") == ERROR, "fail")
    return listed.join(counts, "check_name", "left").select(
        "check_name",
        "test_name",
        "severity",
        n_findings.alias("n_findings"),
        status.otherwise("warn").alias("status"),
    )


def store_findings(
    mart: DataFrame,
    sector: str,
    place: TableRef,
    settings: Settings = Settings(),
    checks: Sequence[Check] = CHECKS,
) -> DataFrame:
    """Run checks, save each one's findings to its own table, and append to the run history.

    Each check runs once: its findings are counted while they are written. A check that fails, be it
    while it writes, keeps its former table and has status `error` in the history; the first such error is raised
    once the history is written. What was staged on the way is deleted. Only `place`'s catalog and
    schema are used. Returns this run's history rows.
    """
    spark = mart.sparkSession
    run_id, run_at = uuid.uuid4().hex, datetime.now(timezone.utc)
    inputs = CheckInputs(standard_rows(mart, sector, settings), settings, shared=True)
    errors: list[Exception] = []

    def store(check: Check) -> tuple:
        table = place.beside(check.test_name(sector))
        try:
            found, counted = counting_findings(check.run(inputs))
            write_table(found, table)
            n_findings = counted.get["n_findings"]
            status = status_of(check.severity, n_findings)
        except Exception as error:
            errors.append(error)
            n_findings, status = None, FAILED
        tags = ",".join(check.tags)
        name, severity = check.name, check.severity
        return run_id, run_at, table.identifier, name, severity, tags, n_findings, status

    with staged_until_done(spark), ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        prepare(inputs, checks, pool)
        release_shuffles(spark)
        results = list(pool.map(in_same_scope(store), checks))
    history = spark.createDataFrame(results, HISTORY_SCHEMA)
    append_table(history, place.beside(HISTORY_TABLE))
    if errors:
        raise errors[0]
    return history


def stored_findings(
    spark: SparkSession, sectors: Sequence[str], place: TableRef, checks: Sequence[Check] = CHECKS
) -> DataFrame:
    """The stored findings of the latest runs; checks that have not run are left out."""
    parts = []
    for sector in sectors:
        for check in checks:
            table = place.beside(check.test_name(sector))
            if table_exists(spark, table):
                parts.append(_common(read_table(spark, table), check, sector))
    return _combined(spark, parts)
