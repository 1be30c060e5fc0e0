"""Schedules and years that are blank, missing or too short.

All four checks read one small relation: the number of rows of each company-year-schedule. It is
stored, because most of them read it more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.operators.firsts import with_first_uid
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage

_COMPANY_YEAR = ["sector", "company", "disclosure_year"]
_SCHEDULE = [*_COMPANY_YEAR, "schedule"]

# Rows of a hot year are spread over this many join keys.
_SPREAD = 64


def schedule_sizes(rows: DataFrame) -> DataFrame:
    """Rows, and rows with neither value nor text, of each company-year-schedule; staged."""
    is_empty = F.col("value").isNull() & F.col("text_value").isNull()
    sizes = rows.groupBy(*_COMPANY_YEAR, "schedule").agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_empty).alias("n_empty"),
    )
    return stage(sizes, "schedule-sizes")


def blank_schedule(
    sizes: DataFrame, rows: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Schedules of some length where most rows hold neither a value nor text."""
    blank = (
        sizes.withColumn("empty_share", F.col("n_empty") / F.col("n_rows"))
        .where(F.col("n_rows") >= settings.blank_min_rows)
        .where(F.col("empty_share") >= settings.blank_share)
    )
    return with_first_uid(blank, rows, _SCHEDULE).select(
        F.lit("blank_schedule").alias("check_name"),
        *_COMPANY_YEAR,
        "schedule",
        F.lit(None).cast("string").alias("item"),
        "uid",
        "n_rows",
        "empty_share",
    )


def row_count_drop(
    sizes: DataFrame, rows: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Schedules with far fewer rows than the company's median year. NULL names never match."""
    over_years = Window.partitionBy("sector", "company", "schedule")
    short = (
        sizes.where(F.col("company").isNotNull() & F.col("schedule").isNotNull())
        .withColumn("usual_rows", F.median("n_rows").over(over_years))
        .withColumn("_n_years", F.count("*").over(over_years))
        .where(F.col("_n_years") >= settings.drop_min_years)
        .where(F.col("n_rows") < settings.drop_share * F.col("usual_rows"))
    )
    return with_first_uid(short, rows, _SCHEDULE).select(
        F.lit("row_count_drop").alias("check_name"),
        *_COMPANY_YEAR,
        "schedule",
        F.lit(None).cast("string").alias("item"),
        "uid",
        "n_rows",
        "usual_rows",
    )


def _holes_between_years(disclosed: DataFrame) -> DataFrame:
    """Company-years without a schedule disclosed the year before and the year after."""
    timeline = Window.partitionBy("sector", "company", "schedule").orderBy("disclosure_year")
    year = F.col("disclosure_year")
    holes = (
        disclosed.where(F.col("company").isNotNull())
        .withColumn("_next", F.lead("disclosure_year").over(timeline))
        .where(F.col("_next") == year + 2)
        .withColumn("disclosure_year", year + 1)
        .select(*_COMPANY_YEAR, "schedule")
    )
    present = disclosed.select(*_COMPANY_YEAR).distinct()
    return holes.join(present, _COMPANY_YEAR, "left_semi")


def _missing_among_peers(
    disclosed: DataFrame, peers: DataFrame, settings: Settings
) -> DataFrame:
    """Company-years without a schedule that most companies disclose that year.

    Each expected schedule of a year is met by that year's companies only. At least `gap_peer_share`
    of the pairs formed are disclosed ones, so there are at most 1 / `gap_peer_share` as many pairs
    as disclosed schedules; a setting near 0 undoes that bound.
    """
    n_expected = settings.gap_peer_share * F.col("n_companies")
    expected = peers.where(
        (F.col("n_companies") >= settings.gap_min_peers) & (F.col("n_disclosing") >= n_expected)
    ).select("sector", "disclosure_year", "schedule")
    spread = F.pmod(F.xxhash64("company"), F.lit(_SPREAD)).cast("int")
    companies = disclosed.select(*_COMPANY_YEAR).distinct().withColumn("_spread", spread)
    expected = expected.withColumn(
        "_spread", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1)))
    )
    pairs = companies.join(expected, ["sector", "disclosure_year", "_spread"]).drop("_spread")
    # A plain comparison: a NULL company never counts as disclosing.
    return pairs.join(disclosed, [*_COMPANY_YEAR, "schedule"], "left_anti")


def schedule_gap(sizes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Schedules missing from a company-year although its neighbour years or its peers have them."""
    disclosed = sizes.where(F.col("schedule").isNotNull()).select(*_COMPANY_YEAR, "schedule")
    per_year = (
        disclosed.select(*_COMPANY_YEAR)
        .distinct()
        .groupBy("sector", "disclosure_year")
        .agg(F.count("*").alias("n_companies"))
    )
    disclosing = disclosed.groupBy("sector", "disclosure_year", "schedule").agg(
        F.count("company").alias("n_disclosing")
    )
    peers = disclosing.join(per_year, ["sector", "disclosure_year"])
    holes = _holes_between_years(disclosed).withColumn("_hole", F.lit(True))
    missing = _missing_among_peers(disclosed, peers, settings).withColumn("_hole", F.lit(False))
    found = (
        holes.unionByName(missing)
        .groupBy(*_COMPANY_YEAR, "schedule")
        .agg(F.max("_hole").alias("had_year_before_and_after"))
    )
    return (
        found.join(per_year, ["sector", "disclosure_year"])
        .join(disclosing, ["sector", "disclosure_year", "schedule"], "left")
        .select(
            F.lit("schedule_gap").alias("check_name"),
            *_COMPANY_YEAR,
            "schedule",
            F.lit(None).cast("string").alias("item"),
            F.lit(None).cast("string").alias("uid"),
            "had_year_before_and_after",
            F.coalesce("n_disclosing", F.lit(0)).cast("bigint").alias("n_disclosing"),
            "n_companies",
        )
    )


def year_gap(sizes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Years without any row between a company's first and last, where the mart has that year.

    Years are numbered in the order the mart has them. Two years of a company whose numbers are
    not consecutive have the missing ones in between, so only missing years are ever generated.
    """
    company_years = sizes.select(*_COMPANY_YEAR).distinct()
    # The mart's distinct years: a few dozen rows.
    numbered = Window.partitionBy("sector").orderBy("disclosure_year")
    years = (
        company_years.select("sector", "disclosure_year")
        .distinct()
        .withColumn("_place", F.row_number().over(numbered))
    )
    placed = company_years.join(years, ["sector", "disclosure_year"])
    company = Window.partitionBy("sector", "company")
    timeline = company.orderBy("_place")
    ranged = (
        placed.withColumn("first_year", F.min("disclosure_year").over(company))
        .withColumn("last_year", F.max("disclosure_year").over(company))
        .withColumn("_next", F.lead("_place").over(timeline))
    )
    # A NULL company matches no row of its own, so its whole range counts as missing.
    after_last = F.when(F.col("company").isNull(), F.coalesce("_next", F.col("_place") + 1))
    start = F.when(F.col("company").isNull(), F.col("_place")).otherwise(F.col("_place") + 1)
    end = F.coalesce(after_last, F.col("_next")) - 1
    missing = ranged.where(start <= end).select(
        "sector",
        "company",
        "first_year",
        "last_year",
        F.explode(F.sequence(start, end)).alias("_place"),
    )
    return missing.join(years, ["sector", "_place"]).select(
        F.lit("year_gap").alias("check_name"),
        *_COMPANY_YEAR,
        F.lit(None).cast("string").alias("schedule"),
        F.lit(None).cast("string").alias("item"),
        F.lit(None).cast("string").alias("uid"),
        "first_year",
        "last_year",
    )
