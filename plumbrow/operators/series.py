"""One company's line item over the years.

A series has at most one value per disclosure year, so it is short. The rows are placed by their series'
hash, once; years, medians, counts and the checks' verdicts are windows on that placement. A hash of so
many rows that no series can be behind it is kept out of that: its rows are reduced to one per series and
year on the map side first, so no task gathers them, however often a key occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same, row_hash
from plumbrow.functions.text import is_variance_like, line_item
from plumbrow.operators.sieve import sifted
from plumbrow.schema import SERIES_KEY, STANDARD_SCHEMA
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage

# Units of money.
MONEY_UNITS = ("$000", "$000s", "$m", "$")

# The hash only goes first so that sorting rarely compares the labels; the labels decide.
SERIES_HASH = "_series_hash"
_HASHED_KEY = [SERIES_HASH, *SERIES_KEY]

# Rows of a hash shared by more than this are reduced on the map side before they are shuffled.
_LONG_SERIES = 10_000


def over_series(aggregate: Column) -> Column:
    """An aggregate over all years of the row's series."""
    return aggregate.over(Window.partitionBy(*_HASHED_KEY))


def _keyed_values(rows: DataFrame) -> DataFrame:
    """The non-zero values with the derived part of their series key."""
    reported_for = F.coalesce(
        F.col("observation_year"),
        F.year("observation_month"),
        F.col("forecast_year"),
        F.year("period_ending"),
    )
    return (
        rows.where(F.col("value").isNotNull() & (F.col("value") != 0))
        .withColumn("column_year_offset", reported_for - F.col("disclosure_year"))
        .withColumn("column_month", F.month("observation_month"))
        .withColumn(SERIES_HASH, row_hash(SERIES_KEY))
    )


def _output(usable: DataFrame) -> DataFrame:
    return (
        usable.withColumn("ratio_to_median", F.abs("value") / F.col("series_median"))
        .withColumn("item", line_item())
        .withColumn("is_variance_like", is_variance_like(F.col("item")))
        .select(
            *STANDARD_SCHEMA.names,
            "item",
            "column_year_offset",
            "column_month",
            "n_years",
            "series_median",
            "ratio_to_median",
            "is_variance_like",
            SERIES_HASH,
        )
    )


def _placed(values: DataFrame, settings: Settings) -> DataFrame:
    """The usable series among values of which no hash has many: one exchange, by the hash."""
    in_year = Window.partitionBy(*_HASHED_KEY, "disclosure_year")
    n_here = F.count("*").over(in_year)
    return (
        values.repartition(SERIES_HASH)
        .withColumn("_here", n_here)
        .withColumns(
            {
                "_most": over_series(F.max("_here")),
                "n_years": over_series(F.count("*")),  # with one value in each
                "series_median": over_series(F.median(F.abs("value"))),
            }
        )
        .where((F.col("_most") == 1) & (F.col("n_years") >= settings.series_min_years))
    )


def _reduced(values: DataFrame, settings: Settings) -> DataFrame:
    """The usable series among any values: judged by numbers counted per year, rows joined back."""
    per_year = values.groupBy(*_HASHED_KEY, "disclosure_year").agg(
        F.count("*").alias("_n"), F.min(F.abs("value")).alias("_size")
    )
    usable = (
        per_year.groupBy(*_HASHED_KEY)
        .agg(
            F.max("_n").alias("_most"),
            F.count("*").alias("n_years"),
            F.median("_size").alias("series_median"),
        )
        .where((F.col("_most") == 1) & (F.col("n_years") >= settings.series_min_years))
    )
    return join_same(values, usable, _HASHED_KEY)


def _usable(values: DataFrame, long_hashes: DataFrame, settings: Settings) -> DataFrame:
    if long_hashes.isEmpty():
        return _placed(values, settings)
    short = _placed(values.join(long_hashes, SERIES_HASH, "left_anti"), settings)
    long = _reduced(values.join(long_hashes, SERIES_HASH, "left_semi"), settings)
    columns = [*values.columns, "n_years", "series_median"]
    return short.select(*columns).unionByName(long.select(*columns))


def series_values(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every non-zero value of every series that is long enough, with the series' median size.

    A series with two values in one year is left out. Runs a job that looks for long hashes.
    """
    values = _keyed_values(rows)
    sizes = values.groupBy(SERIES_HASH).agg(F.count("*").alias("_n_alike"))
    long_hashes = stage(sizes.where(F.col("_n_alike") > _LONG_SERIES), "long-series")
    return _output(_usable(values, long_hashes.select(SERIES_HASH), settings))


def uneven_series_values(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`series_values` without the steady series, in which no value can be out of place, and without the
    line items that vary.

    To be flagged, a value has to be at least ten times larger or smaller than another one of its
    series, or a money value of the opposite sign. The extremes of each series hash show where that may
    be. Two series under one hash only widen the extremes, so none is missed. That takes one shuffle of a
    few numbers per series, and only the rows of uneven series are shuffled with their labels, once.
    """
    values = _keyed_values(rows)
    size, money = F.abs("value"), F.when(F.col("units").isin(*MONEY_UNITS), F.col("value"))
    uneven = (
        values.groupBy(SERIES_HASH)
        .agg(
            F.count("*").alias("_n_alike"),
            F.min(size).alias("_smallest"),
            F.max(size).alias("_largest"),
            F.min(money).alias("_lowest"),
            F.max(money).alias("_highest"),
        )
        .where(F.col("_n_alike") >= settings.series_min_years)
        # A little under ten, for the rounding of the ratios.
        .where(
            (F.col("_largest") >= F.col("_smallest") * 9.99)
            | ((F.col("_lowest") < 0) & (F.col("_highest") > 0))
        )
        .select(SERIES_HASH, "_n_alike")
    )
    uneven = stage(uneven, "uneven-series")
    long_hashes = uneven.where(F.col("_n_alike") > _LONG_SERIES).select(SERIES_HASH)
    # The words are searched for in the few rows that may matter. The condition reads a column of the other side, or
    # the optimizer would move it below the join, to all rows.
    matters = F.when(F.col("_n_alike") > 0, ~is_variance_like(line_item()))
    suspect = sifted(values, uneven, SERIES_HASH).join(uneven, SERIES_HASH).where(matters).drop("_n_alike")
    return _output(_usable(suspect, long_hashes, settings))
