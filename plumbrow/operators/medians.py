"""Exact medians of groups of any size.

Spark's median keeps every distinct value of a group in one buffer. That is right for ordinary
groups. A group with more rows than a limit is instead narrowed down in distributed passes: count
values per sub-range, keep the sub-range holding the middle ranks, and repeat until few values
are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same
from plumbrow.sources.staging import stage

_RANGES = 4096


def grouped_median(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    hot_rows: int,
    extras: Sequence[Column] = (),
) -> DataFrame:
    """Per group of the keys, the exact median of a non-NULL double `value`, plus `extras`."""
    # There are at most (number of rows) / hot_rows hot groups, so their list is small.
    hot = (
        rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select(*keys)
    )
    hot = stage(hot, "hot-groups")
    if hot.isEmpty():
        return rows.groupBy(*keys).agg(F.median(value).alias(name), *extras)
    ordinary = join_same(rows, hot, keys, "left_anti")
    large = join_same(rows, hot, keys, "left_semi")
    medians = _median_by_narrowing(large.select(*keys, value), keys, value, name, hot_rows)
    if extras:
        medians = join_same(medians, large.groupBy(*keys).agg(*extras), keys)
    return ordinary.groupBy(*keys).agg(F.median(value).alias(name), *extras).unionByName(medians)


def _middle(position: Column, total: Column) -> Column:
    """Whether the ranks up to `position`, from the row's own first rank, hold a middle rank."""
    low = F.floor((total + 1) / 2)
    high = F.floor(total / 2) + 1
    first = position - F.col("_n") + 1
    return low.between(first, position) | high.between(first, position)


def _narrow(cells: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """The cells of the buckets that hold a middle rank, with the count of values before them."""
    bucketed = cells.withColumn("_bucket", bucket)
    counts = bucketed.groupBy(*keys, "_before", "_total", "_bucket").agg(F.sum("_n").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_before", "_total").orderBy("_bucket"))
    placed = (
        counts.withColumn("_upto", F.col("_before") + upto)
        .where(_middle(F.col("_upto"), F.col("_total")))
        .select(
            *keys,
            F.col("_before").alias("_was"),
            "_bucket",
            "_total",
            (F.col("_upto") - F.col("_n")).alias("_next"),
        )
    )
    kept = join_same(
        bucketed.withColumnRenamed("_before", "_was"), placed, [*keys, "_was", "_bucket", "_total"]
    )
    return kept.drop("_bucket", "_was").withColumnRenamed("_next", "_before")


def _median_by_narrowing(
    rows: DataFrame, keys: Sequence[str], value: str, name: str, hot_rows: int
) -> DataFrame:
    # Copies of a value collapse on the map side; a cell is one distinct value of a group.
    cells = rows.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    totals = rows.groupBy(*keys).agg(F.count("*").alias("_total"))
    cells = join_same(cells, totals, keys).withColumn("_before", F.lit(0).cast("bigint"))

    # First by size: steps of about one percent, so under 300,000 ranges cover all doubles. The
    # shift puts the smallest positive range above that of zero; infinity and NaN come last.
    steps = F.floor(F.least(F.log2(F.abs("_v")), F.lit(2000.0)) * 64) + 100_000
    by_size = (
        F.when(F.col("_v") > 0, steps)
        .when(F.col("_v") < 0, -steps)
        .otherwise(F.lit(0).cast("bigint"))
    )
    cells = stage(_narrow(cells, keys, by_size), "median-cells")

    # Then by equal parts of what is left, until each part has few distinct values.
    part = [*keys, "_before", "_total"]
    while True:
        spans = stage(
            cells.groupBy(*part)
            .agg(F.count("*").alias("_cells"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            .where((F.col("_cells") > hot_rows) & (F.col("_lo") < F.col("_hi"))),
            "median-spans",
        )
        if spans.isEmpty():
            break
        done = join_same(cells, spans, part, "left_anti")
        wide = join_same(cells, spans.drop("_cells"), part)
        share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        narrowed = _narrow(wide, keys, F.floor(share * _RANGES)).drop("_lo", "_hi")
        cells = stage(done.unionByName(narrowed), "median-cells")

    upto = F.sum("_n").over(Window.partitionBy(*part).orderBy("_v"))
    ranked = cells.withColumn("_upto", F.col("_before") + upto)
    first = F.col("_upto") - F.col("_n") + 1
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor(F.col("_total") / 2) + 1
    at_low = F.max(F.when(low.between(first, F.col("_upto")), F.col("_v")))
    at_high = F.max(F.when(high.between(first, F.col("_upto")), F.col("_v")))
    return ranked.groupBy(*keys).agg((at_low * 0.5 + at_high * 0.5).alias(name))
