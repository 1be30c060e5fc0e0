"""Comparing many nullable columns at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """A 64-bit hash equal for rows that agree in the columns, NULLs included.

    xxhash64 skips NULLs, so the positions of the NULLs go in as one more input. Use it to find
    candidates only; the columns themselves decide.
    """
    nulls = [F.shiftleft(F.isnull(c).cast("bigint"), i % 63) for i, c in enumerate(columns)]
    return F.xxhash64(*columns, reduce(lambda a, b: a + b, nulls))


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of two aliased DataFrames in all the columns."""
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def join_same(
    left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on the columns with NULL equal to NULL, keeping the left side's copy of them."""
    joined = left.alias("l").join(right.alias("r"), same("l", "r", columns), how)
    if how in ("left_semi", "left_anti"):
        return joined
    kept = [F.col(f"r.{c}") for c in right.columns if c not in columns]
    return joined.select("l.*", *kept)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)
