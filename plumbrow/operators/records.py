"""Errors in single interruption records.

Fourteen of the rules look at one record only: they run as filters over one scan without any
shuffle. Only the copy rule compares records, by the narrow hash of operators.repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.dates import (
    clock_text,
    days_outside_year,
    disclosure_year,
    seconds_between,
    swapped_disclosure_year,
)
from plumbrow.functions.keys import any_of
from plumbrow.functions.text import number_text, shortest_text
from plumbrow.operators.repeats import number_copies, repeat_candidates
from plumbrow.schema import RECORD_ERROR_COLUMNS

# What makes two records copies of each other: everything but where they came from.
COPY_COLUMNS = [
    "edb",
    "disc_yr",
    "subnetwork",
    "row_num",
    "interruption_identifier",
    "circuit_location",
    "feeder",
    "start_datetime",
    "end_datetime",
    "saidi_value",
    "saifi_value",
    "number_of_icps_interrupted",
    "icp_interruption_minutes",
    "planned_or_unplanned",
    "cause",
    "explanation",
]

DUPLICATE_ROW = "DUPLICATE_ROW"


@dataclass(frozen=True)
class Rule:
    """A rule that looks at one record. The detail may name the texts of `_shown`."""

    name: str
    breaks: Column
    detail: Column


def _values() -> dict[str, Column]:
    """The record's measurements as doubles and its times without a zone."""
    start = F.col("start_datetime").cast("timestamp_ntz")
    end = F.col("end_datetime").cast("timestamp_ntz")
    return {
        "start": start,
        "end": end,
        "minutes": seconds_between(start, end) / 60.0,
        "saidi": F.col("saidi_value").cast("double"),
        "saifi": F.col("saifi_value").cast("double"),
        "icps": F.col("number_of_icps_interrupted").cast("double"),
        "icp_minutes": F.col("icp_interruption_minutes").cast("double"),
        "year": F.col("disc_yr").cast("int"),
    }


def _missing(*parts: tuple[Column, str]) -> Column:
    named = [F.when(is_missing, name) for is_missing, name in parts]
    return F.concat(F.lit("Blank: "), F.concat_ws(" ", *named))


def _shown() -> dict[str, Column]:
    """The numbers that details show, by the name of their text."""
    v = _values()
    minutes, saidi, saifi = v["minutes"], v["saidi"], v["saifi"]
    return {
        "_early_minutes": F.round(-minutes, 1),
        "_seconds": F.round(minutes * 60),
        "_whole_minutes": F.round(minutes),
        "_icps": v["icps"],
        "_saidi": saidi,
        "_saifi": saifi,
        "_saifi_floor": F.round(F.try_divide(saidi, minutes), 5),
        "_saifi_minutes": F.round(saifi * minutes, 5),
    }


def _with_shown_texts(records: DataFrame) -> DataFrame:
    """The records with the texts of `_shown`, each formed once, in steps the planner keeps apart."""
    shown = _shown()
    return (
        records.withColumns({f"{name}_number": number for name, number in shown.items()})
        .withColumns({f"{name}_short": shortest_text(F.col(f"{name}_number")) for name in shown})
        .withColumns(
            {name: number_text(F.col(f"{name}_number"), F.col(f"{name}_short")) for name in shown}
        )
    )


# The rule names and the wording of the details.
def rules() -> list[Rule]:
    """The rules that look at one record. A rule with a NULL condition is not broken."""
    v = _values()
    start, end, minutes = v["start"], v["end"], v["minutes"]
    saidi, saifi, icps, icp_minutes = v["saidi"], v["saifi"], v["icps"], v["icp_minutes"]
    year = v["year"]
    text = F.lit

    looks_swapped = (swapped_disclosure_year(start) == year) & (days_outside_year(start, year) > 7)
    saifi_floor = F.try_divide(saidi, minutes)
    saidi_ceiling = 2 * (saifi + 0.00005) * minutes + 0.0001
    kind = F.col("planned_or_unplanned")
    is_known_class = kind.ilike("planned%") | kind.ilike("unplanned%") | kind.isin("B", "C")
    no_identifier = F.col("interruption_identifier").isNull()
    no_feeder = F.col("feeder").isNull() & F.col("circuit_location").isNull()

    return [
        Rule(
            "MISSING_START_OR_END",
            start.isNull() | end.isNull(),
            text("Start or end date/time is blank"),
        ),
        Rule(
            "START_OUTSIDE_DISCLOSURE_YEAR",
            disclosure_year(start) != year,
            F.concat(
                text("Start "),
                clock_text(start),
                text(" is not in DY"),
                year.cast("string"),
                F.when(looks_swapped, " - day and month look swapped").otherwise(""),
            ),
        ),
        Rule(
            "END_BEFORE_START",
            minutes < 0,
            F.concat(text("End is "), F.col("_early_minutes"), text(" min before start")),
        ),
        Rule("ZERO_DURATION", minutes == 0, text("Start and end are identical")),
        Rule(
            "UNDER_1_MINUTE",
            (minutes > 0) & (minutes < 1),
            F.concat(
                text("Lasts "),
                F.col("_seconds"),
                text(" s - not an interruption by definition"),
            ),
        ),
        Rule(
            "MISSING_VALUE",
            saidi.isNull() | saifi.isNull() | icps.isNull() | icp_minutes.isNull(),
            _missing(
                (saidi.isNull(), "SAIDI"),
                (saifi.isNull(), "SAIFI"),
                (icps.isNull(), "ICPs"),
                (icp_minutes.isNull(), "ICP-minutes"),
            ),
        ),
        Rule(
            "NEGATIVE_VALUE",
            (saidi < 0) | (saifi < 0) | (icps < 0) | (icp_minutes < 0),
            text("Negative SAIDI, SAIFI, ICPs or ICP-minutes"),
        ),
        Rule(
            "FRACTIONAL_ICPS",
            F.abs(icps - F.round(icps)) > 0.001,
            F.concat(
                text("ICPs interrupted = "), F.col("_icps"), text(" (must be a whole number)")
            ),
        ),
        Rule(
            "SAIDI_OR_SAIFI_WITH_NO_ICPS",
            (icps == 0) & ((saidi > 0) | (saifi > 0)),
            F.concat(
                text("ICPs interrupted = 0 but SAIDI "),
                F.col("_saidi"),
                text(", SAIFI "),
                F.col("_saifi"),
            ),
        ),
        Rule(
            "SAIFI_ZERO_BUT_SAIDI_REQUIRES_IT",
            (saifi == 0) & (icps > 0) & (minutes >= 1) & (saifi_floor >= 0.0001),
            F.concat(
                text("SAIFI = 0 but SAIDI "),
                F.col("_saidi"),
                text(" over "),
                F.col("_whole_minutes"),
                text(" min needs SAIFI >= "),
                F.col("_saifi_floor"),
            ),
        ),
        Rule(
            "SAIDI_EXCEEDS_PHYSICAL_MAXIMUM",
            (saifi > 0) & (minutes >= 1) & (saidi > saidi_ceiling),
            F.concat(
                text("SAIDI "),
                F.col("_saidi"),
                text(" > 2 x SAIFI x duration ("),
                F.col("_saifi_minutes"),
                text(")"),
            ),
        ),
        Rule(
            "INVALID_CLASS",
            kind.isNull() | ~is_known_class,
            F.concat(text("Planned/unplanned field = "), F.coalesce(kind, text("(blank)"))),
        ),
        Rule(
            "TRANSPOWER_CLASS_D_ROW",
            F.col("cause").ilike("%transpower%"),
            F.concat(
                text('Cause "'),
                F.col("cause"),
                text('" - Class D interruption should not be in 10a'),
            ),
        ),
        Rule(
            "MISSING_IDENTIFIER_OR_FEEDER",
            no_identifier | no_feeder,
            _missing((no_identifier, "identifier"), (no_feeder, "feeder/circuit")),
        ),
    ]


# The names of all fifteen rules.
RULE_NAMES = (
    "DUPLICATE_ROW",
    "MISSING_START_OR_END",
    "START_OUTSIDE_DISCLOSURE_YEAR",
    "END_BEFORE_START",
    "ZERO_DURATION",
    "UNDER_1_MINUTE",
    "MISSING_VALUE",
    "NEGATIVE_VALUE",
    "FRACTIONAL_ICPS",
    "SAIDI_OR_SAIFI_WITH_NO_ICPS",
    "SAIFI_ZERO_BUT_SAIDI_REQUIRES_IT",
    "SAIDI_EXCEEDS_PHYSICAL_MAXIMUM",
    "INVALID_CLASS",
    "TRANSPOWER_CLASS_D_ROW",
    "MISSING_IDENTIFIER_OR_FEEDER",
)


def _identity() -> list[Column]:
    """Which record an error is about: the first four output columns."""
    return [
        F.col("edb"),
        F.col("disc_yr").cast("int").alias("disc_yr"),
        F.col("row_num"),
        F.col("interruption_identifier"),
    ]


def dated_records(interruptions: DataFrame) -> DataFrame:
    """Each record's clock times, its length in minutes, and the disclosure years it may be in."""
    v = _values()
    return interruptions.select(
        *_identity(),
        v["start"].alias("start_at"),
        v["end"].alias("end_at"),
        v["minutes"].alias("duration_min"),
        disclosure_year(v["start"]).alias("start_dy"),
        swapped_disclosure_year(v["start"]).alias("swapped_dy"),
        days_outside_year(v["start"], v["year"]).alias("days_outside_dy"),
    )


def _copy_detail(copy: Column) -> Column:
    return F.concat(F.lit("Exact copy of another row (copy "), copy.cast("string"), F.lit(")"))


def _copied_records(interruptions: DataFrame) -> DataFrame:
    """Each record that occurs more than once, with the number of times it does."""
    return (
        repeat_candidates(interruptions, COPY_COLUMNS)
        .groupBy(*COPY_COLUMNS)
        .agg(F.count("*").alias("_n_copies"))
        .where(F.col("_n_copies") > 1)
    )


def duplicate_errors(interruptions: DataFrame) -> DataFrame:
    """One error for every copy of a record after the first."""
    copied = _copied_records(interruptions)
    copies = number_copies(copied, "_n_copies", "_copy", spread_by=["edb", "row_num"])
    return copies.select(
        *_identity(),
        F.lit(DUPLICATE_ROW).alias("check_name"),
        _copy_detail(F.col("_copy")).alias("detail"),
    )


def single_record_errors(interruptions: DataFrame) -> DataFrame:
    """One row per record and broken rule, for the rules that look at one record."""
    checks = rules()
    broken = F.array(*[F.when(rule.breaks, rule.name) for rule in checks])
    detail = F.lit(None).cast("string")
    for rule in checks:
        detail = F.when(F.col("check_name") == rule.name, rule.detail).otherwise(detail)
    # Sound records leave at the filter, before anything is written about them.
    flagged = interruptions.where(any_of([rule.breaks for rule in checks]))
    return (
        _with_shown_texts(flagged)
        .withColumn("check_name", F.explode(broken))
        .where("check_name IS NOT NULL")
        .select(*_identity(), "check_name", detail.alias("detail"))
    )


def errors_of_rule(interruptions: DataFrame, name: str) -> DataFrame:
    """The errors of one rule, as a plain filter that reaches the scan."""
    if name == DUPLICATE_ROW:
        return duplicate_errors(interruptions)
    by_name = {r.name: r for r in rules()}
    if name not in by_name:
        raise ValueError(f"no rule {name!r}; rules: {', '.join(RULE_NAMES)}")
    rule = by_name[name]
    return _with_shown_texts(interruptions.where(rule.breaks)).select(
        *_identity(), F.lit(name).alias("check_name"), rule.detail.alias("detail")
    )


def record_errors(interruptions: DataFrame) -> DataFrame:
    """One row per record per broken rule."""
    errors = single_record_errors(interruptions).unionByName(duplicate_errors(interruptions))
    return errors.select(*RECORD_ERROR_COLUMNS)


def record_errors_summary(interruptions: DataFrame) -> DataFrame:
    """Records affected by each rule, by EDB and disclosure year. NULL names are left out."""
    place = ["edb", "disc_yr"]
    single = (
        single_record_errors(interruptions)
        .groupBy(*place, "check_name")
        .agg(F.count("*").alias("rows_affected"), F.min("detail").alias("example_detail"))
    )
    # Copies are counted without writing one row for each. Of the texts for copies 2 to n, the
    # first in text order is number 10 when there is one, else number 2.
    first_text = F.when(F.col("_n_copies") >= 10, F.lit(10)).otherwise(F.lit(2))
    copies = (
        _copied_records(interruptions)
        .withColumn("disc_yr", F.col("disc_yr").cast("int"))
        .groupBy(*place, F.lit(DUPLICATE_ROW).alias("check_name"))
        .agg(
            F.sum(F.col("_n_copies") - 1).alias("rows_affected"),
            F.min(_copy_detail(first_text)).alias("example_detail"),
        )
    )
    totals = (
        interruptions.select("edb", F.col("disc_yr").cast("int").alias("disc_yr"))
        .groupBy(*place)
        .agg(F.count("*").alias("total_rows"))
    )
    affected, total = F.col("rows_affected"), F.col("total_rows")
    # Exact decimal division, so a percentage on a half is always rounded up.
    percent = (affected * 100).cast("decimal(20,0)") / total.cast("decimal(20,0)")
    return (
        single.unionByName(copies)
        .join(totals, place)
        .select(
            *place,
            "check_name",
            "rows_affected",
            "total_rows",
            F.round(percent, 2).cast("double").alias("pct_rows"),
            "example_detail",
        )
    )
