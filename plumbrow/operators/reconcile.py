"""Sums of interruption records next to separately reported totals.

One row per EDB, disclosure year and class (B planned, C unplanned), with both sides' measures,
their differences in percent, and a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.operators.repeats import drop_copies
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage

# How the reported lines are named.
RELIABILITY_SCHEDULE = "SCHEDULE 10: REPORT ON NETWORK RELIABILITY"
BY_CLASS = "SAIFI and SAIDI by class"
TRANSITIONAL = "Transitional SAIFI and SAIDI (previous method)"
COUNTS = "Interruptions by class"
N_INTERRUPTIONS = "Number of interruptions"

_KEY = ["edb", "disc_yr", "class"]


def reported_measures(totals: DataFrame) -> DataFrame:
    """The reported lines, one row per EDB, year and class B, C or D."""
    lines = totals.where(
        (F.col("schedule") == RELIABILITY_SCHEDULE)
        & (F.col("network") == "All")
        & F.col("section").startswith("10(i)")
        & F.col("description").like("Class _ (%")
    ).withColumn("class", F.substring("description", 7, 1))

    def measure(category: str, sub_category: str) -> Column:
        wanted = (F.col("category") == category) & (F.col("sub_category") == sub_category)
        return F.sum(F.when(wanted, F.col("value"))).cast("double")

    def unless_zero(column: Column) -> Column:
        return F.nullif(column, F.lit(0.0))

    return (
        lines.where(F.col("class").isin("B", "C", "D"))
        .groupBy(*_KEY)
        .agg(
            measure(BY_CLASS, "SAIDI").alias("saidi_s10"),
            measure(BY_CLASS, "SAIFI").alias("saifi_s10"),
            measure(COUNTS, N_INTERRUPTIONS).alias("n_s10"),
            unless_zero(measure(TRANSITIONAL, "SAIDI")).alias("saidi_s10_transitional"),
            unless_zero(measure(TRANSITIONAL, "SAIFI")).alias("saifi_s10_transitional"),
        )
    )


def record_measures(interruptions: DataFrame) -> DataFrame:
    """The records summed per EDB, year and class, after dropping exact copies.

    A record is unplanned when its kind says so and planned otherwise, also when it is blank or a
    bare class letter. Decimal inputs are summed exactly, so the result does not depend on order.
    """
    kind = F.col("planned_or_unplanned")
    is_transpower = F.col("cause").ilike("%transpower%")

    def transpower_sum(column: str) -> Column:
        return F.sum(F.when(is_transpower, F.col(column)).otherwise(F.lit(0))).cast("double")

    return (
        drop_copies(interruptions.drop("source"))
        .withColumn("class", F.when(kind.ilike("%unplanned%"), "C").otherwise("B"))
        .groupBy("edb", F.col("disc_yr").cast("int").alias("disc_yr"), "class")
        .agg(
            F.count("*").alias("rows_10a"),
            F.count_distinct("interruption_identifier").alias("ids_10a"),
            F.sum("saidi_value").cast("double").alias("saidi_10a"),
            F.sum("saifi_value").cast("double").alias("saifi_10a"),
            transpower_sum("saidi_value").alias("saidi_10a_transpower"),
            transpower_sum("saifi_value").alias("saifi_10a_transpower"),
        )
    )


def _both_sides(records: DataFrame, reported: DataFrame) -> DataFrame:
    """Records and reported lines side by side, with the EDB-year's class D line on each row.

    Reported years without any record are left out. Class D lines come in through the same join
    and leave again once their values are on the other rows.
    """
    years = records.select("disc_yr").distinct().withColumn("_covered", F.lit(True))
    is_d = F.col("class") == "D"
    compared = (
        reported.join(years, "disc_yr", "left")
        .where(is_d | F.col("_covered").isNotNull())
        .drop("_covered")
    )
    both = records.join(compared, _KEY, "full")
    edb_year = Window.partitionBy("edb", "disc_yr")
    named = F.col("edb").isNotNull() & F.col("disc_yr").isNotNull()

    def of_edb_year(aggregate: Column) -> Column:
        # A missing name equals no other, so such a row has no companions.
        return F.when(named, aggregate.over(edb_year))

    def bc_sum(column: Column) -> Column:
        return of_edb_year(F.sum(F.when(~is_d, column)))

    reported_saidi, reported_saifi = F.col("saidi_s10"), F.col("saifi_s10")
    recorded_saidi = F.coalesce("saidi_10a", F.lit(0.0))
    recorded_saifi = F.coalesce("saifi_10a", F.lit(0.0))
    return (
        both.withColumns(
            {
                "saidi_s10_class_d": of_edb_year(F.max(F.when(is_d, reported_saidi))),
                "saidi_bc_diff_pct": _percent(bc_sum(recorded_saidi), bc_sum(reported_saidi)),
                "saifi_bc_diff_pct": _percent(bc_sum(recorded_saifi), bc_sum(reported_saifi)),
            }
        ).where(~is_d)
    )


def _percent(recorded: Column, reported: Column) -> Column:
    """How far the records are above the reported value, in percent; NULL where that is zero."""
    return 100 * (recorded / F.nullif(reported, F.lit(0.0)) - 1)


# The wording of the verdicts. The first that holds is given.
def _verdict(tolerance: float) -> Column:
    def agrees(column: str, within: float = tolerance) -> Column:
        return F.abs(column) <= within

    recorded, reported = F.col("saidi_10a"), F.col("saidi_s10")
    no_saifi_difference = F.abs(F.coalesce("saifi_diff_pct", F.lit(0.0))) <= tolerance
    return (
        F.when(
            recorded.isNull() & (F.coalesce(reported, F.lit(0.0)) == 0),
            "Match (no interruptions of this class)",
        )
        .when(reported.isNull(), "No Schedule 10 data for this EDB-year")
        .when(recorded.isNull(), "No 10a rows for this class")
        .when(agrees("saidi_diff_pct") & no_saifi_difference, "Match")
        .when(
            (F.col("saidi_10a_transpower") > 0) & agrees("saidi_diff_excl_transpower_pct"),
            "Mismatch: 10a includes Transpower (Class D) rows",
        )
        .when(
            agrees("saidi_diff_pct") & agrees("saifi_diff_vs_transitional_pct", 0.1),
            "Mismatch: 10a SAIFI is on the old (transitional) counting basis",
        )
        .when(
            agrees("saidi_bc_diff_pct") & agrees("saifi_bc_diff_pct"),
            "Mismatch: B + C total matches, planned/unplanned split differs",
        )
        .when(
            (F.col("saidi_diff_pct") < -5) & (F.col("ids_minus_s10_count") < 0),
            "Mismatch: 10a missing interruptions",
        )
        .otherwise("Mismatch: unexplained")
    )


def reconcile(
    interruptions: DataFrame, totals: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Both sides, their differences and a verdict per EDB, year and class."""
    # Read twice below, and one row per EDB, year and class.
    records = stage(record_measures(interruptions), "record-measures")
    both = _both_sides(records, reported_measures(totals))
    recorded_saidi = F.coalesce("saidi_10a", F.lit(0.0))
    recorded_saifi = F.coalesce("saifi_10a", F.lit(0.0))
    without_transpower = F.col("saidi_10a") - F.col("saidi_10a_transpower")
    reported_count = F.coalesce("n_s10", F.lit(0.0))

    def rounded(column: str, places: int) -> Column:
        return F.round(column, places).alias(column)

    return (
        both.withColumn("saidi_diff_pct", _percent(recorded_saidi, F.col("saidi_s10")))
        .withColumn("saifi_diff_pct", _percent(recorded_saifi, F.col("saifi_s10")))
        .withColumn(
            "saifi_diff_vs_transitional_pct",
            _percent(recorded_saifi, F.col("saifi_s10_transitional")),
        )
        .withColumn(
            "saidi_diff_excl_transpower_pct", _percent(without_transpower, F.col("saidi_s10"))
        )
        .withColumn("ids_minus_s10_count", F.coalesce("ids_10a", F.lit(0)) - reported_count)
        .select(
            *_KEY,
            F.when(F.col("class") == "B", "Planned")
            .otherwise("Unplanned")
            .alias("interruption_type"),
            "rows_10a",
            "ids_10a",
            "n_s10",
            rounded("saidi_10a", 4),
            rounded("saidi_s10", 4),
            rounded("saidi_diff_pct", 2),
            rounded("saifi_10a", 4),
            rounded("saifi_s10", 4),
            rounded("saifi_diff_pct", 2),
            rounded("saifi_s10_transitional", 4),
            rounded("saifi_diff_vs_transitional_pct", 2),
            rounded("saidi_10a_transpower", 4),
            rounded("saidi_s10_class_d", 4),
            rounded("saidi_bc_diff_pct", 2),
            rounded("saifi_bc_diff_pct", 2),
            _verdict(settings.tolerance_pct).alias("verdict"),
        )
    )


def verdict_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("verdict").agg(F.count("*").alias("n"))
