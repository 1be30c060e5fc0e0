"""Finding rows that agree in many wide columns, without shuffling the wide columns.

Only an 8-byte hash per row is shuffled to learn which hashes occur more than once. Those few
hashes are staged, so the planner knows their size: it broadcasts them when they are few and
otherwise shuffles both sides, splitting a hash that holds a large part of the rows; rows that cannot
have such a hash are sifted out before. The rows found are then grouped by the columns themselves and
never by the hash, so that the grouping always combines on the map side first and a large group costs
each task one entry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same, row_hash
from plumbrow.operators.sieve import sifted
from plumbrow.sources.staging import stage

ROW_HASH = "_row_hash"
N_ALIKE = "_n_alike"

_NUMBERS_PER_ROW = 100_000

# With more repeated hashes than this, copies are no exception and are dropped in one pass.
_MANY_HASHES = 1_000_000


def _repeated_hashes(keyed: DataFrame) -> DataFrame:
    alike = keyed.groupBy(ROW_HASH).agg(F.count("*").alias(N_ALIKE)).where(F.col(N_ALIKE) > 1)
    return stage(alike, "repeated-hashes")


def repeat_candidates(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row that may agree with another row in the columns.

    Adds the row hash and the number of rows sharing it, which bounds the size of the row's set.
    """
    keyed = rows.withColumn(ROW_HASH, row_hash(columns))
    repeated = _repeated_hashes(keyed)
    return sifted(keyed, repeated, ROW_HASH).join(repeated, ROW_HASH)


def drop_copies(rows: DataFrame) -> DataFrame:
    """`rows.distinct()`, where only rows with a repeated hash are shuffled as a whole."""
    keyed = rows.withColumn(ROW_HASH, row_hash(rows.columns))
    repeated = _repeated_hashes(keyed)
    if repeated.count() > _MANY_HASHES:
        return rows.distinct()
    single = keyed.join(repeated, ROW_HASH, "left_anti").select(*rows.columns)
    copies = keyed.join(repeated, ROW_HASH, "left_semi").select(*rows.columns)
    return single.unionByName(copies.distinct())


def set_members(
    candidates: DataFrame, sets: DataFrame, hashed: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per member of each set: what makes the set, its first uid, and the member's uid.

    `hashed` are the columns behind the candidates' row hash, `columns` those that make a set. The
    columns tell sets apart where uids are NULL or repeat.
    """
    heads = stage(
        sets.select(
            row_hash(hashed).alias(ROW_HASH), *columns, F.col("uid").alias("set_uid")
        ),
        "repeated-sets",
    )
    return join_same(candidates, heads, [ROW_HASH, *columns]).select(*columns, "set_uid", "uid")


def number_copies(
    sets: DataFrame, count: str, number: str, spread_by: Sequence[str]
) -> DataFrame:
    """One row for each copy after the first, numbered from 2.

    A set of any size becomes rows of at most 100,000 numbers each before these are spread over
    the cluster, so no task writes out a large set alone.
    """
    spark = sets.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.lit(_NUMBERS_PER_ROW).cast("bigint")
    last_chunk = F.floor((F.col(count) - 2) / size)
    first = F.col("_chunk") * size + 2
    return (
        sets.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
        .repartition(tasks, *spread_by, "_chunk")
        .withColumn(
            number, F.explode(F.sequence(first, F.least(F.col(count), first + size - 1)))
        )
        .drop("_chunk")
    )
