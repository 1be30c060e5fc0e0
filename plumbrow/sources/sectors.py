"""Mapping a sector's mart to the standard columns.

A new mart is added by one mapping from standard column to expression; the columns it leaves out
become typed NULLs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.text import blank_to_null
from plumbrow.schema import STANDARD_SCHEMA
from plumbrow.settings import Settings

Mapping = dict[str, Column]


def _edb() -> Mapping:
    def text(name: str) -> Column:
        return blank_to_null(F.col(name))

    return {
        "company": text("edb"),
        "network": text("network"),
        "disclosure_year": F.col("disc_yr"),
        "schedule_reference": F.col("sch_ref"),
        "section_number": text("sect_no"),
        "source": text("source"),
        "schedule": text("schedule"),
        "section": text("section"),
        "category_1": text("category"),
        "category_2": text("sub_category"),
        "description": text("description"),
        "observation_year": F.col("obs_yr"),
        "forecast_year": F.col("fcast_yr"),
        "units": text("units"),
        "value": F.col("value"),
        "text_value": text("text_input"),
        "version": text("version"),
        "uid": F.col("uid"),
    }


SECTORS: dict[str, Callable[[], Mapping]] = {"edb": _edb}


def standard_rows(mart: DataFrame, sector: str, settings: Settings = Settings()) -> DataFrame:
    """The mart's rows under the standard columns, from the first disclosure year onwards."""
    if sector not in SECTORS:
        raise ValueError(f"no column mapping for sector {sector!r}; mapped: {sorted(SECTORS)}")
    mapping = {"sector": F.lit(sector), **SECTORS[sector]()}
    columns = [
        mapping.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in STANDARD_SCHEMA
    ]
    return mart.select(*columns).where(F.col("disclosure_year") >= settings.min_disclosure_year)
