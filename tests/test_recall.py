"""The defects injected into the samples are known by predicate; so are their numbers."""

from __future__ import annotations

import pytest

from plumbrow.operators.reconcile import reconcile, verdict_counts
from plumbrow.operators.records import record_errors
from plumbrow.plans.findings import run_check
from plumbrow.plans.registry import find_check
from plumbrow.settings import Settings
from plumbrow.sources.samples import sample_interruptions, sample_mart, sample_totals

SF_DIR = "/root/testdata/sf0.01"
SETTINGS = Settings(min_disclosure_year=1995)

# Findings in the nation-grain mart at sf0.01.
FINDINGS = {
    "scale_break": 9,
    "magnitude_outlier": 4 + 23,
    "sign_flip": 10,
    "percent_as_proportion": 72,
    "blank_schedule": 2,
    "schedule_gap": 58,
    "row_count_drop": 3,
    "year_gap": 7,
    "duplicate_rows": 106,
    "ambiguous_rows": 275,
    "units_within_year": 15,
    "units_across_years": 3,
    "units_are_units": 6,
}

ERRORS = {
    "DUPLICATE_ROW": 253,
    "MISSING_START_OR_END": 165,
    "ZERO_DURATION": 102,
    "END_BEFORE_START": 98,
    "UNDER_1_MINUTE": 179,
    "START_OUTSIDE_DISCLOSURE_YEAR": 216,
    "MISSING_VALUE": 475,
    "NEGATIVE_VALUE": 450,
    "SAIDI_EXCEEDS_PHYSICAL_MAXIMUM": 230,
    "FRACTIONAL_ICPS": 169,
    "SAIDI_OR_SAIFI_WITH_NO_ICPS": 52,
    "SAIFI_ZERO_BUT_SAIDI_REQUIRES_IT": 245,
    "INVALID_CLASS": 287,
    "TRANSPOWER_CLASS_D_ROW": 179,
    "MISSING_IDENTIFIER_OR_FEEDER": 226,
}

VERDICTS = {
    "Match": 73,
    "Match (no interruptions of this class)": 3,
    "No Schedule 10 data for this EDB-year": 5,
    "No 10a rows for this class": 3,
    "Mismatch: 10a includes Transpower (Class D) rows": 2,
    "Mismatch: 10a SAIFI is on the old (transitional) counting basis": 5,
    "Mismatch: B + C total matches, planned/unplanned split differs": 6,
    "Mismatch: 10a missing interruptions": 6,
    "Mismatch: unexplained": 7,
}


def test_mart_size(spark):
    mart = sample_mart(spark, SF_DIR, by_supplier=False)
    assert mart.count() == 19_682
    assert mart.select("edb").distinct().count() == 27


@pytest.mark.parametrize("name", sorted(FINDINGS))
def test_finds_the_injected_defects(spark, name):
    mart = sample_mart(spark, SF_DIR, by_supplier=False)
    assert run_check(find_check(name), mart, "edb", SETTINGS).count() == FINDINGS[name]


def test_record_errors(spark):
    errors = record_errors(sample_interruptions(spark, SF_DIR))
    assert dict(errors.groupBy("check_name").count().collect()) == ERRORS
    swapped = errors.where("detail like '%look swapped'").count()
    assert swapped == 33


def test_all_nine_verdicts(spark):
    result = reconcile(sample_interruptions(spark, SF_DIR), sample_totals(spark, SF_DIR))
    assert dict(verdict_counts(result).collect()) == VERDICTS
