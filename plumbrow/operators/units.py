"""Line items in several units, and units that are not units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.text import line_item, normalised_unit, regex_contains
from plumbrow.operators.firsts import with_first_uid
from plumbrow.operators.lists import with_lists
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage

_ITEM = ["sector", "schedule", "item"]
_UNIT = ["sector", "schedule", "units"]


def _with_real_units(rows: DataFrame, ignored: Sequence[str]) -> DataFrame:
    """Rows with a unit, without tariff units (which contain '|') and the ignored ones."""
    return rows.where(~F.col("units").contains("|") & ~F.col("units").isin(*ignored))


def unit_usage(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each spelling of a unit a line item was reported in, per year.

    Staged, because the checks of both scopes read it several times.
    """
    usage = (
        _with_real_units(rows, settings.non_units)
        .select("sector", "schedule", line_item().alias("item"), "disclosure_year", "units")
        .distinct()
        .withColumn("unit_key", normalised_unit(F.col("units")))
    )
    return stage(usage, "unit-usage")


def _mixed_items(usage: DataFrame) -> DataFrame:
    """Line items with more than one unit, and whether units are mixed inside a year.

    A plain schedule comparison follows the counts, so items without a schedule drop out.
    """
    usage = usage.where(F.col("schedule").isNotNull())
    per_year = usage.groupBy(*_ITEM, "disclosure_year").agg(
        F.count_distinct("unit_key").alias("_in_year")
    )
    within = per_year.groupBy(*_ITEM).agg((F.max("_in_year") > 1).alias("_mixed_in_a_year"))
    overall = (
        usage.groupBy(*_ITEM)
        .agg(
            F.count_distinct("unit_key").alias("n_units"),
            F.count_distinct("units").alias("_n_spellings"),
        )
        .where(F.col("n_units") > 1)
    )
    return overall.join(within, _ITEM)


def item_spellings(usage: DataFrame) -> DataFrame:
    """Every spelling of every line item, one per row."""
    return usage.select(*_ITEM, "unit_key", "units").distinct()


def _inconsistent_units(
    usage: DataFrame, rows: DataFrame, settings: Settings, within_year: bool
) -> DataFrame:
    scope = "within_year" if within_year else "across_years"
    of_items = _with_real_units(rows, settings.non_units).withColumn("item", line_item())
    mixed = _mixed_items(usage).where(F.col("_mixed_in_a_year") == F.lit(within_year))
    items = with_first_uid(mixed, of_items, _ITEM)
    counted = item_spellings(usage).withColumn("_copies", F.lit(1).cast("bigint"))
    listed = with_lists(
        items, counted, _ITEM, "_n_spellings", "units", "units_used", settings.list_part
    )
    return listed.select(
        F.lit(f"units_{scope}").alias("check_name"),
        "sector",
        F.lit(None).cast("string").alias("company"),
        F.lit(None).cast("int").alias("disclosure_year"),
        "schedule",
        "item",
        "uid",
        "n_units",
        "units_used",
        "part",
        "n_parts",
    )


def units_within_year(
    usage: DataFrame, rows: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Line items reported in different units in the same year."""
    return _inconsistent_units(usage, rows, settings, within_year=True)


def units_across_years(
    usage: DataFrame, rows: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Line items whose unit changes between years but is the same inside each year."""
    return _inconsistent_units(usage, rows, settings, within_year=False)


def units_are_units(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Units that are a bare number, or that equal a label used anywhere in the mart."""
    units = _with_real_units(rows, [*settings.non_units, *settings.allowed_words])
    candidates = stage(
        units.groupBy(*_UNIT).agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("company").alias("n_companies"),
            F.min("disclosure_year").alias("first_year"),
            F.max("disclosure_year").alias("last_year"),
        ),
        "unit-candidates",
    )
    # Only labels that occur as units are made distinct.
    named = F.explode(F.array("category_1", "category_2", "category_3", "description"))
    labels = (
        rows.select("sector", named.alias("units"))
        .join(candidates.select("sector", "units"), ["sector", "units"], "left_semi")
        .distinct()
        .withColumn("_is_label", F.lit(True))
    )
    is_number = regex_contains(F.col("units"), "^[0-9.]+$")
    flagged = candidates.join(labels, ["sector", "units"], "left").where(
        is_number | F.col("_is_label").isNotNull()
    )
    return (
        with_first_uid(flagged, units, _UNIT)
        .select(
            F.lit("units_are_units").alias("check_name"),
            "sector",
            F.lit(None).cast("string").alias("company"),
            F.lit(None).cast("int").alias("disclosure_year"),
            "schedule",
            F.col("units").alias("item"),
            "uid",
            "n_rows",
            "n_companies",
            "first_year",
            "last_year",
        )
    )
