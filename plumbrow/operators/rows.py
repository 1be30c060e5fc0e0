"""Rows that share a cell: exact repeats and contradicting values.

Both are found among the rows whose labels repeat, so one pass over the hashes serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.text import line_item
from plumbrow.operators.lists import with_lists
from plumbrow.operators.repeats import repeat_candidates, set_members
from plumbrow.schema import LABELS
from plumbrow.settings import Settings
from plumbrow.sources.staging import stage

_CELL = ["sector", *LABELS]
_CELL_AND_CONTENT = [*_CELL, "value", "text_value"]


def cell_repeats(rows: DataFrame) -> DataFrame:
    """The rows that may share their cell with another row, stored: both checks read them often."""
    return stage(repeat_candidates(rows, _CELL), "cell-repeats")


def _counted(repeats: DataFrame, columns: list[str]) -> DataFrame:
    return repeats.groupBy(*columns, "uid").agg(F.count("*").alias("_copies"))


def _duplicate_sets(repeats: DataFrame) -> DataFrame:
    return (
        repeats.groupBy(*_CELL_AND_CONTENT)
        .agg(F.count("*").alias("n_rows"), F.min("uid").alias("uid"))
        .where(F.col("n_rows") > 1)
    )


def duplicate_rows(repeats: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Sets of rows with the same labels, value and text; uid and version are not compared.

    One row for each part of a set's list of uids, which nearly always is a single one.
    """
    counted = _counted(repeats, _CELL_AND_CONTENT)
    return with_lists(
        _duplicate_sets(repeats),
        counted,
        _CELL_AND_CONTENT,
        "n_rows",
        "uid",
        "uids",
        settings.list_part,
    ).select(
        F.lit("duplicate_rows").alias("check_name"),
        "sector",
        "company",
        "disclosure_year",
        "schedule",
        line_item().alias("item"),
        "uid",
        "n_rows",
        "uids",
        "part",
        "n_parts",
        "value",
        "text_value",
    )


def duplicate_row_members(repeats: DataFrame) -> DataFrame:
    """Every row of every duplicate set, one per line."""
    return set_members(repeats, _duplicate_sets(repeats), _CELL, _CELL_AND_CONTENT)


def _ambiguous_sets(repeats: DataFrame) -> DataFrame:
    return (
        repeats.groupBy(*_CELL)
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct(F.struct("value", "text_value")).alias("n_values"),
            F.min("uid").alias("uid"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
        .where((F.col("n_rows") > 1) & (F.col("n_values") > 1))
    )


def ambiguous_rows(repeats: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Sets of rows with the same labels but different values or texts, by parts of their lists."""
    counted = _counted(repeats, _CELL)
    return with_lists(
        _ambiguous_sets(repeats), counted, _CELL, "n_rows", "uid", "uids", settings.list_part
    ).select(
        F.lit("ambiguous_rows").alias("check_name"),
        "sector",
        "company",
        "disclosure_year",
        "schedule",
        line_item().alias("item"),
        "uid",
        "n_rows",
        "n_values",
        "uids",
        "part",
        "n_parts",
        "min_value",
        "max_value",
    )


def ambiguous_row_members(repeats: DataFrame) -> DataFrame:
    """Every row of every ambiguous set, one per line."""
    return set_members(repeats, _ambiguous_sets(repeats), _CELL, _CELL)
