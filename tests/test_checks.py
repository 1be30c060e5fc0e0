"""One firing case and one near miss per rule, on hand-built rows."""

from __future__ import annotations

import pytest

from plumbrow.plans.registry import CheckInputs, find_check
from plumbrow.settings import Settings
from plumbrow.sources.sectors import standard_rows
from tests.marts import series, standard


def findings(spark, name, rows, shared=False, **settings):
    inputs = CheckInputs(standard(spark, rows), Settings(**settings), shared=shared)
    return find_check(name).run(inputs).collect()


def steady(value=100.0, years=range(2015, 2021)):
    return {y: value + y % 3 for y in years}


def test_unmapped_sector(spark):
    with pytest.raises(ValueError, match="no column mapping"):
        standard_rows(spark.range(1), "gas")


def test_standard_rows_trims_and_drops_early_years(spark):
    mart = spark.createDataFrame(
        [(" A ", y, "  ", "u") for y in (2012, 2013, None)],
        "edb string, disc_yr int, units string, uid string",
    )
    for name in (
        "network sch_ref sect_no source schedule section category sub_category description obs_yr "
        "fcast_yr value text_input version"
    ).split():
        mart = mart.selectExpr("*", f"cast(null as string) as {name}")
    row = standard_rows(mart, "edb").collect()
    assert [(r.company, r.disclosure_year, r.units) for r in row] == [("A", 2013, None)]


def test_duplicates_ignore_uid_and_version_and_match_nulls(spark):
    rows = [
        {"uid": "b", "version": "2"},
        {"uid": "a"},
        {"uid": "c", "value": 2.0, "network": None},
        {"uid": "d", "value": 2.0, "network": None},
        {"uid": "e", "section": "x", "category_1": None},
        {"uid": "f", "section": None, "category_1": "x"},
    ]
    found = findings(spark, "duplicate_rows", rows)
    assert sorted((r.uid, r.uids, r.n_rows) for r in found) == [("a", "a, b", 2), ("c", "c, d", 2)]
    assert findings(spark, "ambiguous_rows", rows) == []


def test_ambiguous_rows_count_missing_values(spark):
    rows = [{"uid": "a", "value": None}, {"uid": "b", "value": 5.0}, {"uid": "c", "value": 5.0}]
    (found,) = findings(spark, "ambiguous_rows", rows)
    assert (found.n_rows, found.n_values, found.min_value, found.max_value) == (3, 2, 5.0, 5.0)
    assert len(findings(spark, "duplicate_rows", rows)) == 1


@pytest.mark.parametrize("shared", [False, True])
def test_scale_break(spark, shared):
    block = {**steady(), 2016: 100_000.0, 2017: 101_000.0}
    found = findings(spark, "scale_break", series(block), shared)
    assert {(r.disclosure_year, r.scale) for r in found} == {
        (2016, "1,000x larger"),
        (2017, "1,000x larger"),
    }


def test_scale_break_near_misses(spark):
    two_scales = series({**steady(), 2016: 100_000.0, 2017: 0.1}, description="two")
    half = series({2015: 1.0, 2016: 1.0, 2017: 1000.0, 2018: 1000.0}, description="half")
    varies = series({**steady(), 2016: 100_000.0}, description="Total tax")
    hundred = series({**steady(), 2016: 10_000.0}, description="hundred")
    assert findings(spark, "scale_break", two_scales + half + varies + hundred) == []


def test_scale_break_of_a_proportion(spark):
    values = {**{y: 0.8 for y in range(2015, 2020)}, 2020: 80.0}
    (found,) = findings(spark, "scale_break", series(values, units="proportion"))
    assert (found.disclosure_year, found.scale) == (2020, "100x larger")


def test_a_series_with_two_values_in_a_year_is_skipped(spark):
    rows = series({**steady(), 2016: 100_000.0}) + series({2018: 7.0})
    assert findings(spark, "scale_break", rows) == []


def test_series_tell_nulls_in_different_labels_apart(spark):
    left = series({2015: 1.0, 2016: 1.0}, section="x", category_1=None)
    right = series({2017: 1.0, 2018: 1.0, 2019: 1000.0}, section=None, category_1="x")
    assert findings(spark, "scale_break", left + right) == []


def test_magnitude_outlier(spark):
    large = series({**steady(), 2018: 1e8}, description="large")
    lone_small = series({**steady(), 2018: 1e-4}, description="small", schedule="lone")
    three = [
        row
        for d in ("p", "q", "r")
        for row in series({**steady(), 2018: 1e-4}, description=d, schedule="three")
    ]
    found = findings(spark, "magnitude_outlier", large + lone_small + three)
    assert sorted(r.item[-5:] for r in found) == sorted(["large", *(f"s / {d}" for d in "pqr")])


def test_sign_flip(spark):
    flipped = series({**steady(), 2018: -100.0}, description="one")
    positive = series({2015: -9.0, 2016: -9.0, 2017: 9.0, 2018: -9.0}, description="two")
    twice = series({**steady(), 2017: -100.0, 2018: -100.0}, description="both")
    size = series({**steady(), 2018: -1000.0}, description="size")
    no_money = series({**steady(), 2018: -100.0}, description="km", units="km")
    rows = flipped + positive + twice + size + no_money
    found = findings(spark, "sign_flip", rows)
    assert sorted((r.item, r.value) for r in found) == [
        ("Opex / Lines / one", -100.0),
        ("Opex / Lines / two", 9.0),
    ]


def test_percent_as_proportion(spark):
    def companies(**shares):
        return [{"company": c, "units": "proportion", "value": v} for c, v in shares.items()]

    (found,) = findings(spark, "percent_as_proportion", companies(A=23.0, B=0.2, C=0.3))
    assert (found.company, found.company_median, found.n_companies) == ("A", 23.0, 3)
    assert findings(spark, "percent_as_proportion", companies(A=23.0, B=0.2)) == []
    assert findings(spark, "percent_as_proportion", companies(A=1.2, B=0.2, C=0.3)) == []
    assert findings(spark, "percent_as_proportion", companies(A=230.0, B=0.2, C=0.3)) == []


def test_units(spark):
    same_unit = [{"units": "$000"}, {"company": "B", "units": "$000s"}]
    assert findings(spark, "units_within_year", same_unit) == []
    mixed = [{"units": "$000"}, {"company": "B", "units": "km"}, {"company": "C", "units": None}]
    (found,) = findings(spark, "units_within_year", mixed)
    assert (found.n_units, found.units_used) == (2, "$000, km")
    assert findings(spark, "units_across_years", mixed) == []
    changed = [{"units": "$000"}, {"units": "km", "disclosure_year": 2021}]
    assert findings(spark, "units_within_year", changed) == []
    assert len(findings(spark, "units_across_years", changed)) == 1
    ignored = [{"units": "$000"}, {"units": "a|b"}, {"units": "no unit"}]
    assert findings(spark, "units_within_year", ignored) == []


def test_units_are_units(spark):
    rows = [
        {"units": "12.5"},
        {"units": "Lines", "company": "B"},
        {"units": "Lines"},
        {"units": "km"},
        {"units": "value", "description": "value"},
        {"units": None},
    ]
    found = findings(spark, "units_are_units", rows)
    assert sorted((r.item, r.n_rows, r.n_companies) for r in found) == [
        ("12.5", 1, 1),
        ("Lines", 2, 2),
    ]


def test_blank_schedule(spark):
    def schedule(n_blank, n_rows, **labels):
        return [
            {"description": str(i), "value": None if i < n_blank else 1.0, **labels}
            for i in range(n_rows)
        ]

    rows = (
        schedule(16, 20)
        + schedule(15, 20, company="B")
        + schedule(19, 19, company="C")
        + schedule(20, 20, company="D", text_value="text")
    )
    (found,) = findings(spark, "blank_schedule", rows)
    assert (found.company, found.n_rows, found.empty_share) == ("A", 20, 0.8)


def years(company, schedules):
    return [
        {"company": company, "disclosure_year": y, "schedule": s}
        for s, listed in schedules.items()
        for y in listed
    ]


def test_schedule_gap_between_years(spark):
    rows = years("A", {"S": [2015, 2017, 2019, 2020], "T": range(2015, 2021)})
    found = findings(spark, "schedule_gap", rows)
    assert {(r.disclosure_year, r.schedule) for r in found} == {(2016, "S"), (2018, "S")}
    assert {(r.had_year_before_and_after, r.n_disclosing, r.n_companies) for r in found} == {
        (True, 0, 1)
    }
    # Nothing at all in 2016: that is a year gap.
    assert findings(spark, "schedule_gap", years("A", {"S": [2015, 2017]})) == []


def test_schedule_gap_among_peers(spark):
    full = [row for c in "ABC" for row in years(c, {"S": [2015], "T": [2015]})]
    rows = full + years("D", {"T": [2015]})
    assert findings(spark, "schedule_gap", rows) == []
    rows += years("E", {"S": [2015], "T": [2015]})
    (found,) = findings(spark, "schedule_gap", rows)
    assert (found.company, found.n_disclosing, found.n_companies) == ("D", 4, 5)
    assert not found.had_year_before_and_after
    # A company without a name counts, but matches nothing it disclosed itself.
    nameless = rows + years(None, {"S": [2015], "T": [2015]})
    found = findings(spark, "schedule_gap", nameless, gap_peer_share=0.6)
    assert sorted((r.company or "", r.schedule) for r in found) == [
        ("", "S"),
        ("", "T"),
        ("D", "S"),
    ]


def test_row_count_drop(spark):
    def sized(company, **sizes):
        return [
            {"company": company, "disclosure_year": int(y[1:]), "description": str(i)}
            for y, n in sizes.items()
            for i in range(n)
        ]

    rows = (
        sized("A", y2015=8, y2016=8, y2017=1)
        + sized("B", y2015=8, y2016=8, y2017=2)
        + sized("C", y2015=8, y2016=1)
        + sized(None, y2015=8, y2016=8, y2017=1)
    )
    (found,) = findings(spark, "row_count_drop", rows)
    assert (found.company, found.n_rows, found.usual_rows) == ("A", 1, 8.0)


def test_year_gap(spark):
    rows = (
        years("A", {"S": [2015, 2019]})
        + years("B", {"S": [2016, 2017]})
        + years(None, {"S": [2016, 2019]})
    )
    found = findings(spark, "year_gap", rows)
    assert sorted((r.company or "", r.disclosure_year) for r in found) == [
        ("", 2016),
        ("", 2017),
        ("", 2019),
        ("A", 2016),
        ("A", 2017),
    ]
    assert {(r.first_year, r.last_year) for r in found if r.company == "A"} == {(2015, 2019)}


def test_year_gap_survives_a_wild_year(spark):
    rows = years("A", {"S": [2015, 2_000_000_000]}) + years("B", {"S": [2016]})
    found = findings(spark, "year_gap", rows)
    assert [(r.company, r.disclosure_year) for r in found] == [("A", 2016)]
