"""The canonical schemas: standard rows, findings and record errors."""

from __future__ import annotations

from pyspark.sql import types as T

STANDARD_SCHEMA = T.StructType(
    [
        T.StructField("sector", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("network", T.StringType()),
        T.StructField("disclosure_year", T.IntegerType()),
        T.StructField("schedule_reference", T.StringType()),
        T.StructField("section_number", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("schedule", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("category_1", T.StringType()),
        T.StructField("category_2", T.StringType()),
        T.StructField("category_3", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("period_beginning", T.DateType()),
        T.StructField("period_ending", T.DateType()),
        T.StructField("observation_year", T.IntegerType()),
        T.StructField("observation_month", T.DateType()),
        T.StructField("forecast_year", T.IntegerType()),
        T.StructField("actual_or_forecast", T.StringType()),
        T.StructField("units", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("text_value", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("uid", T.StringType()),
    ]
)

# What names one cell: every standard column but these.
_NOT_LABELS = {"sector", "value", "text_value", "version", "uid"}
LABELS = [name for name in STANDARD_SCHEMA.names if name not in _NOT_LABELS]

# What names one company's line item across years. The last two are derived, see operators.series.
SERIES_KEY = [
    "sector",
    "company",
    "network",
    "source",
    "schedule",
    "section",
    "category_1",
    "category_2",
    "category_3",
    "description",
    "units",
    "actual_or_forecast",
    "column_year_offset",
    "column_month",
]

ITEM_LABELS = ["section", "category_1", "category_2", "category_3", "description"]

FINDING_COLUMNS = ["check_name", "sector", "company", "disclosure_year", "schedule", "item", "uid"]

ALL_FINDINGS_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("test_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("disclosure_year", T.IntegerType()),
        T.StructField("schedule", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("uid", T.StringType()),
    ]
)

RECORD_ERROR_COLUMNS = [
    "edb",
    "disc_yr",
    "row_num",
    "interruption_identifier",
    "check_name",
    "detail",
]
