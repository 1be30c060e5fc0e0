"""Small hand-built standard rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbrow.schema import STANDARD_SCHEMA

_DEFAULTS = {
    "sector": "edb",
    "company": "A",
    "network": "All",
    "disclosure_year": 2020,
    "schedule": "S",
    "section": "Opex",
    "category_1": "Lines",
    "description": "Total",
    "units": "$000",
    "value": 1.0,
    "version": "1",
}


def standard(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rows of the defaults overlaid with the given columns; uids are numbered."""
    filled = []
    for i, row in enumerate(rows):
        merged = {**_DEFAULTS, "uid": f"u{i:04d}", **row}
        merged.setdefault("observation_year", merged["disclosure_year"])
        filled.append(tuple(merged.get(name) for name in STANDARD_SCHEMA.names))
    return spark.createDataFrame(filled, STANDARD_SCHEMA)


def series(values: dict[int, float], **labels) -> list[dict]:
    return [{"disclosure_year": y, "value": v, **labels} for y, v in values.items()]
