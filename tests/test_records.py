"""Record rules and reconciliation on hand-built records."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbrow.operators.constraints import accepted_values, not_null
from plumbrow.operators.reconcile import (
    BY_CLASS,
    COUNTS,
    N_INTERRUPTIONS,
    RELIABILITY_SCHEDULE,
    TRANSITIONAL,
    reconcile,
)
from plumbrow.operators.records import (
    RULE_NAMES,
    errors_of_rule,
    record_errors,
    record_errors_summary,
    rules,
    single_record_errors,
)
from plumbrow.sources.samples import sample_interruptions

SCHEMA = (
    "edb string, disc_yr int, subnetwork string, row_num bigint, interruption_identifier string, "
    "circuit_location string, feeder string, start_datetime timestamp_ntz, "
    "end_datetime timestamp_ntz, saidi_value double, saifi_value double, "
    "number_of_icps_interrupted double, icp_interruption_minutes double, "
    "planned_or_unplanned string, cause string, explanation string, source string"
)
SOUND = {
    "edb": "E",
    "disc_yr": 2024,
    "row_num": 1,
    "interruption_identifier": "I1",
    "feeder": "F1",
    "start_datetime": datetime(2023, 6, 1, 10),
    "end_datetime": datetime(2023, 6, 1, 11),
    "saidi_value": 0.6,
    "saifi_value": 0.01,
    "number_of_icps_interrupted": 10.0,
    "icp_interruption_minutes": 600.0,
    "planned_or_unplanned": "Unplanned",
    "cause": "Vegetation",
}
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


def records(spark, *changes: dict):
    rows = [{**SOUND, **change} for change in changes]
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], SCHEMA)


CASES = [
    ({}, {}),
    ({"end_datetime": None}, {"MISSING_START_OR_END": "Start or end date/time is blank"}),
    (
        {"start_datetime": datetime(2024, 4, 1), "end_datetime": datetime(2024, 4, 1, 1)},
        {"START_OUTSIDE_DISCLOSURE_YEAR": "Start 2024-04-01 00:00:00 is not in DY2024"},
    ),
    (
        {"start_datetime": datetime(2023, 1, 6), "end_datetime": datetime(2023, 1, 6, 1)},
        {
            "START_OUTSIDE_DISCLOSURE_YEAR": "Start 2023-01-06 00:00:00 is not in DY2024"
            " - day and month look swapped"
        },
    ),
    (
        {"end_datetime": datetime(2023, 6, 1, 9, 59, 30)},
        {"END_BEFORE_START": "End is 0.5 min before start"},
    ),
    ({"end_datetime": SOUND["start_datetime"]}, {"ZERO_DURATION": "Start and end are identical"}),
    (
        {"end_datetime": datetime(2023, 6, 1, 10, 0, 59)},
        {"UNDER_1_MINUTE": "Lasts 59 s - not an interruption by definition"},
    ),
    (
        {"saidi_value": None, "icp_interruption_minutes": None},
        {"MISSING_VALUE": "Blank: SAIDI ICP-minutes"},
    ),
    ({"icp_interruption_minutes": -1.0}, {"NEGATIVE_VALUE": None}),
    (
        {"number_of_icps_interrupted": 10.5},
        {"FRACTIONAL_ICPS": "ICPs interrupted = 10.5 (must be a whole number)"},
    ),
    ({"number_of_icps_interrupted": 10.0005}, {}),
    (
        {"number_of_icps_interrupted": 0.0},
        {"SAIDI_OR_SAIFI_WITH_NO_ICPS": "ICPs interrupted = 0 but SAIDI 0.6, SAIFI 0.01"},
    ),
    (
        {"saifi_value": 0.0},
        {
            "SAIFI_ZERO_BUT_SAIDI_REQUIRES_IT": "SAIFI = 0 but SAIDI 0.6 over 60 min "
            "needs SAIFI >= 0.01"
        },
    ),
    ({"saifi_value": 0.0, "saidi_value": 0.005}, {}),
    (
        {"saidi_value": 1.3},
        {"SAIDI_EXCEEDS_PHYSICAL_MAXIMUM": "SAIDI 1.3 > 2 x SAIFI x duration (0.6)"},
    ),
    ({"planned_or_unplanned": "B"}, {}),
    ({"planned_or_unplanned": "PLANNED outage"}, {}),
    ({"planned_or_unplanned": None}, {"INVALID_CLASS": "Planned/unplanned field = (blank)"}),
    ({"planned_or_unplanned": "b"}, {"INVALID_CLASS": "Planned/unplanned field = b"}),
    (
        {"cause": "TransPower fault"},
        {
            "TRANSPOWER_CLASS_D_ROW": 'Cause "TransPower fault" - Class D interruption should not '
            "be in 10a"
        },
    ),
    ({"feeder": None, "circuit_location": "C"}, {}),
    (
        {"feeder": None, "interruption_identifier": None},
        {"MISSING_IDENTIFIER_OR_FEEDER": "Blank: identifier feeder/circuit"},
    ),
]


def test_single_rules(spark):
    """Each record breaks just the rules listed, and each rule alone finds the same."""
    df = records(spark, *[{**change, "row_num": i} for i, (change, _) in enumerate(CASES)]).cache()
    found = record_errors(df).collect()
    for i, (_, expected) in enumerate(CASES):
        errors = {r.check_name: r.detail for r in found if r.row_num == i}
        assert errors.keys() == expected.keys(), (i, errors)
        assert all(detail in (None, errors[name]) for name, detail in expected.items()), errors
    for name in RULE_NAMES[1:]:
        alone = sorted(errors_of_rule(df, name).collect(), key=str)
        assert alone == sorted((r for r in found if r.check_name == name), key=str)


def test_times_are_shown_as_on_the_clock(spark):
    """Half past two does not exist in Auckland in this night, but a clock may have shown it."""
    at = datetime(2023, 9, 24, 2, 30)
    df = records(spark, {"disc_yr": 2020, "start_datetime": at, "end_datetime": at})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        (found,) = errors_of_rule(df, "START_OUTSIDE_DISCLOSURE_YEAR").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found.detail == "Start 2023-09-24 02:30:00 is not in DY2020"


def test_rule_names(spark):
    assert [r.name for r in rules()] == list(RULE_NAMES[1:])


def test_unknown_rule(spark):
    with pytest.raises(ValueError, match="no rule"):
        errors_of_rule(records(spark, {}), "NO_SUCH_RULE")


def test_copies_ignore_the_source(spark):
    same = [{"source": f"file {i}"} for i in range(12)]
    df = records(spark, *same, {"row_num": 2}, {"row_num": 3, "feeder": None}, {"edb": None})
    found = errors_of_rule(df, "DUPLICATE_ROW").collect()
    assert sorted(int(r.detail.split("(copy ")[1][:-1]) for r in found) == list(range(2, 13))
    summary = {
        (r.check_name): (r.rows_affected, r.total_rows, r.pct_rows, r.example_detail)
        for r in record_errors_summary(df).collect()
    }
    # Of 'copy 2' to 'copy 12' the first in text order is 'copy 10'.
    first = min(r.detail for r in found)
    assert summary == {
        "DUPLICATE_ROW": (11, 14, 78.57, first),
        "MISSING_IDENTIFIER_OR_FEEDER": (1, 14, 7.14, "Blank: feeder/circuit"),
    }


def totals(spark, *lines: tuple):
    rows = [
        ("All", RELIABILITY_SCHEDULE, "10(i): x", category, sub, f"Class {c} (x", edb, yr, value)
        for edb, yr, c, category, sub, value in lines
    ]
    return spark.createDataFrame(
        rows,
        "network string, schedule string, section string, category string, sub_category string, "
        "description string, edb string, disc_yr int, value double",
    )


def both(edb, class_, saidi, saifi, year=2024):
    return [
        (edb, year, class_, BY_CLASS, "SAIDI", saidi),
        (edb, year, class_, BY_CLASS, "SAIFI", saifi),
    ]


def verdicts(spark, interruptions, lines):
    found = reconcile(interruptions, totals(spark, *lines)).collect()
    return {(r.edb, r["class"]): r.verdict for r in found}


def test_verdicts(spark):
    saidi, saifi = {"saidi_value": 10.0}, {"saifi_value": 1.0}
    sums = {**saidi, **saifi}
    df = records(
        spark,
        {"edb": "match", **sums},
        {"edb": "match", **sums, "source": "again"},
        {"edb": "zero", **sums},
        {"edb": "nothing", **sums},
        {"edb": "transpower", **sums},
        {"edb": "transpower", **sums, "row_num": 2, "cause": "transpower"},
        {"edb": "old", **sums},
        {"edb": "split", **sums},
        {"edb": "split", **sums, "row_num": 2, "planned_or_unplanned": "Planned"},
        {"edb": "missing", **sums},
        {"edb": "close", **sums},
        {"edb": "bare", **sums, "planned_or_unplanned": "C"},
        {"edb": None, **sums},
    )
    lines = [
        *both("match", "C", 10.0, 1.0),
        *both("match", "B", 0.0, 0.0),
        *both("zero", "C", 0.0, 0.0),
        *both("transpower", "C", 10.0, 1.0),
        *both("old", "C", 10.0, 2.0),
        ("old", 2024, "C", TRANSITIONAL, "SAIFI", 1.0),
        *both("split", "C", 12.0, 1.2),
        *both("split", "B", 8.0, 0.8),
        *both("missing", "C", 20.0, 2.0),
        ("missing", 2024, "C", COUNTS, N_INTERRUPTIONS, 2.0),
        *both("close", "C", 10.04, 1.0),
        *both("close", "D", 3.0, 1.0),
        *both("bare", "B", 10.0, 1.0),
        *both("reported only", "C", 5.0, 1.0),
        *both("other year", "C", 5.0, 1.0, year=2020),
        *both(None, "C", 10.0, 1.0),
    ]
    split = "Mismatch: B + C total matches, planned/unplanned split differs"
    found = verdicts(spark, df, lines)
    # A missing EDB matches no reported line, so both sides show up alone under the same key.
    assert found.pop((None, "C")) in (
        "No Schedule 10 data for this EDB-year",
        "No 10a rows for this class",
    )
    assert found == {
        ("match", "C"): "Match",
        ("match", "B"): "Match (no interruptions of this class)",
        ("zero", "C"): "Mismatch: unexplained",
        ("nothing", "C"): "No Schedule 10 data for this EDB-year",
        ("transpower", "C"): "Mismatch: 10a includes Transpower (Class D) rows",
        ("old", "C"): "Mismatch: 10a SAIFI is on the old (transitional) counting basis",
        ("split", "C"): split,
        ("split", "B"): split,
        ("missing", "C"): "Mismatch: 10a missing interruptions",
        ("close", "C"): "Match",
        ("bare", "B"): "Match",
        ("reported only", "C"): "No 10a rows for this class",
    }
    result = reconcile(df, totals(spark, *lines)).where("edb = 'close'").first()
    assert (result.saidi_s10_class_d, result.rows_10a, result.interruption_type) == (
        3.0,
        1,
        "Unplanned",
    )


def test_constraints(spark):
    df = spark.createDataFrame([("B",), ("C",), ("X",), ("X",), (None,)], "class string")
    assert not_null(df, "class").count() == 1
    unexpected = accepted_values(df, "class", ["B", "C"]).collect()
    assert [tuple(r) for r in unexpected] == [("X", 2)]
    assert not_null(df.where(F.col("class").isNotNull()), "class").isEmpty()


def test_record_rules_compile(spark):
    """The stages of all rules at once stay small enough to be compiled as a whole."""
    records = sample_interruptions(spark, "/root/testdata/sf0.001")
    name = "spark.sql.codegen.fallback"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        errors = record_errors(records)
        assert errors.count() > 0
        assert record_errors_summary(records).count() > 0
    finally:
        spark.conf.set(name, before)
    plan = single_record_errors(records)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 60_000
