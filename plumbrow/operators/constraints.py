"""Constraints on the columns of a result. Each returns the offending rows or values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows whose column is NULL."""
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The values outside the accepted ones, with their number of rows. NULL is not judged."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )
