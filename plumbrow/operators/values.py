"""Values on the wrong scale, of the wrong size, or with the wrong sign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same
from plumbrow.functions.text import line_item
from plumbrow.operators.medians import grouped_median
from plumbrow.operators.series import MONEY_UNITS, over_series
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage

_HEAD = ["sector", "company", "disclosure_year", "schedule", "item", "uid", "units", "value"]


def _count_if(condition: Column) -> Column:
    return over_series(F.count_if(condition))


def _scale() -> Column:
    """Where a value lies next to its series' median; NULL for no scale in particular.

    The first range that holds decides, so a ratio on two bounds takes the wider scale.
    """
    ratio = F.col("ratio_to_median")
    is_proportion = F.col("units") == "proportion"
    return (
        F.when(ratio.between(1 / 3, 3.0), "normal")
        .when(ratio.between(300.0, 3000.0), "1,000x larger")
        .when(ratio.between(1 / 3000, 1 / 300), "1,000x smaller")
        .when(is_proportion & ratio.between(30.0, 300.0), "100x larger")
        .when(is_proportion & ratio.between(1 / 300, 1 / 30), "100x smaller")
    )


def judged_values(series: DataFrame) -> DataFrame:
    """The values of steady line items, each judged by the three checks below.

    All three look at the same series, so their counts share one partitioning. Items that change
    size and sign legitimately are left out. Takes `series_values` or `uneven_series_values`.
    """
    ratio, value, n_years = F.col("ratio_to_median"), F.col("value"), F.col("n_years")
    is_off_scale = F.col("scale") != "normal"
    off_scale = F.when(is_off_scale, F.col("scale"))
    is_extreme = (ratio >= 10000) | (ratio <= 0.0001)
    only_negative = (value < 0) & (F.col("_n_positive") == n_years - 1)
    only_positive = (value > 0) & (F.col("_n_positive") == 1)
    return (
        series.where(~F.col("is_variance_like"))
        .withColumn("scale", _scale())
        .withColumns(
            {
                "_n_normal": _count_if(F.col("scale") == "normal"),
                "_n_off": _count_if(is_off_scale),
                "_first_off": over_series(F.min(off_scale)),
                "_last_off": over_series(F.max(off_scale)),
                "_n_agreeing": _count_if(ratio.between(0.1, 10.0)),
                "_n_positive": _count_if(value > 0),
            }
        )
        .withColumns(
            {
                "is_scale_break": is_off_scale
                & (F.col("_n_normal") + F.col("_n_off") == n_years)
                & (F.col("_first_off") == F.col("_last_off"))
                & (F.col("_n_off") < F.col("_n_normal")),
                "is_outlier": is_extreme & (F.col("_n_agreeing") == n_years - 1),
                "is_sign_flip": F.col("units").isin(*MONEY_UNITS)
                & (F.col("_n_normal") == n_years)
                & (only_negative | only_positive),
            }
        )
        .select(
            *_HEAD,
            "n_years",
            "series_median",
            "ratio_to_median",
            "scale",
            "is_scale_break",
            "is_outlier",
            "is_sign_flip",
        )
    )


def suspect_values(series: DataFrame) -> DataFrame:
    """The few judged values that any of the three checks picks out."""
    return judged_values(series).where(
        F.coalesce("is_scale_break", F.lit(False))
        | F.coalesce("is_outlier", F.lit(False))
        | F.coalesce("is_sign_flip", F.lit(False))
    )


def scale_break(judged: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Values about 1,000 times off (proportions also about 100 times) in an otherwise even series.

    All values off the normal scale are on one other scale, and they are the minority.
    """
    return judged.where("is_scale_break").select(
        F.lit("scale_break").alias("check_name"),
        *_HEAD,
        "series_median",
        "ratio_to_median",
        "scale",
    )


def magnitude_outlier(judged: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The one value at least 10,000 times off where all other years agree.

    A very small value counts only with at least three outliers in its company-year-schedule.
    """
    outliers = judged.where("is_outlier").select(*_HEAD, "series_median", "ratio_to_median")
    outliers = stage(outliers, "outliers")
    place = ["sector", "company", "disclosure_year", "schedule"]
    # Counted by a grouping, not a window, so a schedule full of outliers stays distributed.
    per_place = outliers.groupBy(*place).agg(F.count("*").alias("_n_here"))
    is_large = F.abs("value") > F.col("series_median")
    return (
        join_same(outliers, per_place, place)
        .where(is_large | (F.col("_n_here") >= 3))
        .select(
            F.lit("magnitude_outlier").alias("check_name"),
            *_HEAD,
            "series_median",
            "ratio_to_median",
        )
    )


def sign_flip(judged: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The one money value whose sign differs from all other years at a similar size."""
    return judged.where("is_sign_flip").select(
        F.lit("sign_flip").alias("check_name"), *_HEAD, "series_median", "n_years"
    )


def percent_as_proportion(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Companies whose proportions look like percentages next to those of their peers."""
    proportions = rows.where((F.col("units") == "proportion") & (F.col("value") != 0)).select(
        "sector",
        "company",
        "schedule",
        line_item().alias("item"),
        F.abs("value").alias("_size"),
        "disclosure_year",
        "uid",
    )
    by_company = grouped_median(
        proportions,
        ["sector", "company", "schedule", "item"],
        "_size",
        "company_median",
        settings.hot_group_rows,
        extras=[
            F.min("disclosure_year").alias("first_year"),
            F.max("disclosure_year").alias("last_year"),
            F.min("uid").alias("uid"),
        ],
    )
    by_company = stage(by_company, "company-medians")
    peers = grouped_median(
        by_company,
        ["sector", "schedule", "item"],
        "company_median",
        "peer_median",
        settings.hot_group_rows,
        extras=[F.count("*").alias("n_companies")],
    ).where((F.col("peer_median") <= 1) & (F.col("n_companies") >= 3))
    suspects = by_company.where((F.col("company_median") > 1.5) & (F.col("company_median") <= 100))
    return suspects.join(peers, ["sector", "schedule", "item"]).select(
        F.lit("percent_as_proportion").alias("check_name"),
        "sector",
        "company",
        F.lit(None).cast("int").alias("disclosure_year"),
        "schedule",
        "item",
        "uid",
        "company_median",
        "peer_median",
        "n_companies",
        "first_year",
        "last_year",
    )
