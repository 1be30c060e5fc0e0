"""The ways around hot groups give the same, whole results as the plain operators."""

from __future__ import annotations

import random
import statistics
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from plumbrow.operators import coverage, firsts, repeats, series, units
from plumbrow.operators.lists import first_parts
from plumbrow.operators.medians import grouped_median
from plumbrow.operators.repeats import drop_copies
from plumbrow.operators.rows import (
    ambiguous_row_members,
    ambiguous_rows,
    cell_repeats,
    duplicate_row_members,
    duplicate_rows,
)
from plumbrow.operators.series import series_values, uneven_series_values
from plumbrow.operators.units import item_spellings, unit_usage, units_within_year
from plumbrow.operators.values import (
    judged_values,
    percent_as_proportion,
    scale_break,
    sign_flip,
    suspect_values,
)
from plumbrow.plans.registry import CheckInputs, find_check
from plumbrow.settings import Settings
from plumbrow.sources import samples, staging
from plumbrow.sources.sectors import standard_rows
from plumbrow.sources.samples import sample_mart
from tests.marts import standard

SF_DIR = "/root/testdata/sf0.001"
SETTINGS = Settings(min_disclosure_year=1995)


@pytest.fixture(scope="module")
def rows(spark):
    return standard_rows(sample_mart(spark, SF_DIR), "edb", SETTINGS)


@pytest.mark.parametrize("hot_rows", [2, 7, 50])
def test_narrowed_medians_are_exact(spark, hot_rows):
    chance = random.Random(hot_rows)
    groups = {
        "wide": [10 ** chance.uniform(-8, 8) for _ in range(401)],
        "even": [chance.uniform(1.0, 1.0001) for _ in range(400)],
        "copies": [5.0] * 200 + [6.0] * 200,
        "signs": [chance.gauss(0, 1) for _ in range(150)] + [0.0, -0.0],
        "close": [1.0 + i * 2**-52 for i in range(300)],
        "one": [3.5],
        "infinite": [float("inf")] * 30 + [1.0, 2.0, 3.0, 4.0],
        None: [float(i) for i in range(31)],
    }
    data = [(k, i, v) for k, values in groups.items() for i, v in enumerate(values)]
    chance.shuffle(data)
    df = spark.createDataFrame(data, "k string, i int, v double")
    extras = [F.max("i").alias("last")]
    found = grouped_median(df, ["k"], "v", "m", hot_rows, extras).collect()
    assert {r.k: (r.m, r["last"]) for r in found} == {
        k: (pytest.approx(statistics.median(values), rel=1e-15), len(values) - 1)
        for k, values in groups.items()
    }


def parts_of(rows, name):
    """All members over the parts, which are numbered from 1 without a gap."""
    assert sorted(r.part for r in rows) == list(range(1, len(rows) + 1))
    assert {r.n_parts for r in rows} == {len(rows)}
    return sorted(m for r in rows for m in getattr(r, name).split(", ") if m)


def test_long_lists_are_whole_in_numbered_parts(spark):
    hot = [{"uid": f"h{i:02d}", "value": 1.0} for i in range(40)]
    hot += [{"uid": "again", "value": 1.0}] * 25 + [{"uid": None, "value": 1.0}] * 3
    pair = [{"uid": "p1", "company": "B"}, {"uid": "p2", "company": "B"}]
    revised = [{"uid": f"r{i}", "company": "C", "value": float(i)} for i in range(23)]
    cells = cell_repeats(standard(spark, hot + pair + revised))
    few = Settings(list_part=10)
    found = duplicate_rows(cells, few).collect()
    of_a = [r for r in found if r.company == "A"]
    assert {(r.n_rows, r.uid) for r in of_a} == {(68, "again")}
    assert parts_of(of_a, "uids") == sorted(r["uid"] for r in hot if r["uid"])
    assert max(len(r.uids.split(", ")) for r in of_a) < 40
    (of_b,) = [r for r in found if r.company == "B"]
    assert (of_b.n_rows, of_b.uids, of_b.part, of_b.n_parts) == (2, "p1, p2", 1, 1)
    ambiguous = ambiguous_rows(cells, few).collect()
    assert parts_of(ambiguous, "uids") == sorted(r["uid"] for r in revised)
    members = duplicate_row_members(cells).collect()
    assert len(members) == len(hot) + len(pair)
    assert len(ambiguous_row_members(cells).collect()) == len(revised)


def test_a_pair_in_a_large_cell_is_listed(spark):
    """A cell of 10,001 rows of which two agree, and one set of 25,000 rows."""
    cell = [{"uid": f"u{i}", "value": float(max(i, 1))} for i in range(10_001)]
    large = [{"uid": f"s{i}", "company": "B"} for i in range(25_000)]
    cells = cell_repeats(standard(spark, cell + large))
    found = duplicate_rows(cells).collect()
    (pair,) = [r for r in found if r.company == "A"]
    assert (pair.n_rows, pair.uid, pair.uids, pair.n_parts) == (2, "u0", "u0, u1", 1)
    of_b = [r for r in found if r.company == "B"]
    assert len(of_b) == 3
    assert parts_of(of_b, "uids") == sorted(r["uid"] for r in large)
    assert parts_of(ambiguous_rows(cells).collect(), "uids") == sorted(r["uid"] for r in cell)


def test_one_finding_for_each_set_in_all_findings(spark):
    mart = standard(spark, [{"uid": f"u{i}"} for i in range(30)])
    part = Settings(list_part=10)
    inputs = CheckInputs(mart, part)
    assert first_parts(find_check("duplicate_rows").run(inputs)).count() == 1


def test_sets_with_null_uids_stay_apart(spark):
    rows = [{"uid": None, "company": c, "value": v} for c in "AB" for v in (1.0, 2.0) for _ in "xy"]
    members = duplicate_row_members(cell_repeats(standard(spark, rows)))
    counts = members.groupBy("company", "value").count().collect()
    assert sorted((r["company"], r["value"], r["count"]) for r in counts) == [
        (c, v, 2) for c in "AB" for v in (1.0, 2.0)
    ]


def test_long_spelling_lists_are_whole(spark):
    rows = [{"units": f"unit {i}"} for i in range(12)]
    mart = standard(spark, rows)
    usage = unit_usage(mart)
    found = units_within_year(usage, mart, Settings(list_part=5)).collect()
    assert {r.n_units for r in found} == {12}
    assert parts_of(found, "units_used") == sorted(r["units"] for r in rows)
    assert item_spellings(usage).count() == 12


def test_drop_copies_is_distinct(spark, monkeypatch):
    data = [(i % 5, None if i % 3 else "x") for i in range(60)] + [(100, "single")]
    df = spark.createDataFrame(data, "a int, b string")
    expected = sorted(map(str, df.distinct().collect()))
    assert sorted(map(str, drop_copies(df).collect())) == expected
    monkeypatch.setattr(repeats, "_MANY_HASHES", 0)
    assert sorted(map(str, drop_copies(df).collect())) == expected


def test_copies_are_numbered_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_NUMBERS_PER_ROW", 7)
    sets = spark.createDataFrame(
        [(1, "a", 2), (2, "b", 8), (3, "c", 9), (4, "d", 50)],
        "id bigint, k string, n bigint",
    )
    found = repeats.number_copies(sets, "n", "copy", ["id"]).collect()
    for k, n in [("a", 2), ("b", 8), ("c", 9), ("d", 50)]:
        assert sorted(r.copy for r in found if r.k == k) == list(range(2, n + 1))


def test_uneven_series_hold_every_suspect(spark, rows, monkeypatch):
    def suspects(values):
        return sorted((r.uid, r.is_scale_break, r.is_outlier, r.is_sign_flip) for r in values)

    plain = suspects(suspect_values(series_values(rows, SETTINGS)).collect())
    assert plain
    assert suspects(suspect_values(uneven_series_values(rows, SETTINGS)).collect()) == plain
    # Every series counts as a long one.
    monkeypatch.setattr(series, "_LONG_SERIES", 0)
    assert suspects(suspect_values(uneven_series_values(rows, SETTINGS)).collect()) == plain


@pytest.mark.parametrize("hot_rows", [5, 25])
def test_shares_are_found_the_distributed_way_too(spark, hot_rows):
    rows = standard_rows(sample_mart(spark, "/root/testdata/sf0.01"), "edb", SETTINGS)

    def found(settings):
        df = percent_as_proportion(rows, settings)
        kept = [c for c in df.columns if not c.endswith("_median")]
        return sorted(map(str, df.select(*kept, F.round("company_median", 9)).collect()))

    expected = found(SETTINGS)
    assert expected
    assert found(replace(SETTINGS, hot_group_rows=hot_rows)) == expected


def test_one_hot_series_hides_nothing(spark):
    hot = [{"value": 1.0 + i % 2000, "disclosure_year": 2015 + i % 6} for i in range(3000)]
    broken = [
        {"company": "B", "disclosure_year": y, "value": 1000.0 if y == 2015 else 1.0}
        for y in range(2015, 2020)
    ]
    judged = judged_values(uneven_series_values(standard(spark, hot + broken)))
    (found,) = scale_break(judged).collect()
    assert (found.company, found.disclosure_year) == ("B", 2015)
    assert sign_flip(judged).count() == 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_read_only_what_they_need(spark, rows):
    from plumbrow.operators.coverage import blank_schedule, schedule_sizes
    from plumbrow.operators.records import errors_of_rule, single_record_errors
    from plumbrow.sources.samples import sample_interruptions

    records = sample_interruptions(spark, SF_DIR)
    plan = _plan(single_record_errors(records))
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    plan = _plan(errors_of_rule(records, "MISSING_IDENTIFIER_OR_FEEDER"))
    assert "PushedFilters: [Or(IsNull(interruption_identifier)" in plan
    plan = _plan(rows.groupBy("company").count())
    assert "GreaterThanOrEqual(disc_yr,1995)" in plan
    assert "ReadSchema: struct<edb:string,disc_yr:int>" in plan
    assert blank_schedule(schedule_sizes(rows), rows).count() >= 0


def test_no_aggregate_sorts_the_mart(spark, rows, monkeypatch):
    """Of what is staged, only the uids of flagged groups are aggregated by sorting."""
    plans = {}

    def seen(df, label):
        plans[label] = _plan(df)
        return staging.stage(df, label)

    for module in (coverage, units, firsts):
        monkeypatch.setattr(module, "stage", seen)
    sizes, usage = coverage.schedule_sizes(rows), units.unit_usage(rows)
    coverage.blank_schedule(sizes, rows).collect()
    units.units_within_year(usage, rows).collect()
    units.units_are_units(rows).collect()
    plans["series-values"] = _plan(series_values(rows))
    assert {"schedule-sizes", "unit-usage", "unit-candidates", "flagged-groups"} <= set(plans)
    for label, plan in plans.items():
        assert "SortAggregate" not in plan, label
        # Series need no aggregate at all, see test_series_are_placed_once.
        assert "HashAggregate" in plan or label == "series-values", label


@pytest.mark.parametrize("name", ["schedule_gap", "year_gap", "units_are_units", "scale_break"])
def test_no_cross_joins(spark, rows, name):
    from plumbrow.plans.registry import CheckInputs, find_check

    plan = _plan(find_check(name).run(CheckInputs(rows, SETTINGS)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_words_are_searched_for_once_and_after_the_join(spark, rows):
    """A filter with the item's expression written out for every word is too large to be compiled."""
    plan = uneven_series_values(rows, SETTINGS)._jdf.queryExecution().optimizedPlan().toString()
    searching = [x for x in plan.splitlines() if "contains(" in x.lower()]
    assert len(searching) == 1 and searching[0].count("concat_ws") == 1
    assert "Join Inner" in searching[0]


def test_lines_are_dealt_to_small_tasks(spark):
    lines = spark.range(1000).repartition(2).withColumnRenamed("id", "l_orderkey").localCheckpoint()
    assert samples._in_small_tasks(lines, 500).rdd.getNumPartitions() == 2
    dealt = samples._in_small_tasks(lines, 100)
    assert dealt.rdd.getNumPartitions() == 10 and sorted(dealt.collect()) == sorted(lines.collect())


def test_series_are_placed_once(spark, rows):
    """Years, medians, counts and verdicts share one exchange of the rows, and no row is grouped."""
    for judged in (series_values(rows, SETTINGS), judged_values(uneven_series_values(rows, SETTINGS))):
        plan = _plan(judged)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "Aggregate" not in plan and "SortMergeJoin" not in plan
