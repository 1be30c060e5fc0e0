"""Whole lists of members as text, in numbered parts.

A list of few members is one part, which is the usual case. A longer one has as many parts as its
number of members asks for. Members are dealt to the parts by hash after equal ones are counted, and
many equal ones are dealt as several bundles, so that no task gathers a set alone and every member is
in exactly one part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same


def with_lists(
    sets: DataFrame,
    counted: DataFrame,
    keys: Sequence[str],
    size: str,
    member: str,
    name: str,
    part_size: int,
) -> DataFrame:
    """The sets with `part` (from 1), `n_parts` and the sorted members of that part as `name`.

    sets: one row for each set, with its number of members in the column `size`; counted: the sets'
    members with the number of equal ones in `_copies`. NULL members are not listed.
    """
    limit = F.lit(part_size).cast("bigint")
    sized = sets.withColumn("n_parts", F.ceil(F.col(size) / limit).cast("int"))
    members = join_same(counted.where(F.col(member).isNotNull()), sized.select(*keys, "n_parts"), keys)
    bundle = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / limit)))
    dealt = (
        members.withColumn("_bundle", bundle)
        .withColumn("_here", F.least(F.col("_copies") - F.col("_bundle") * limit, limit))
        .withColumn("part", F.pmod(F.xxhash64(member, "_bundle"), F.col("n_parts")).cast("int") + 1)
    )
    copies = F.expr(f"array_repeat(`{member}`, cast(_here as int))")
    listed = F.array_join(F.sort_array(F.flatten(F.collect_list(copies))), ", ")
    lists = dealt.groupBy(*keys, "part").agg(listed.alias(name))
    parts = sized.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("n_parts"))))
    found = join_same(parts, lists, [*keys, "part"], "left")
    return found.withColumn(name, F.coalesce(name, F.lit("")))


def first_parts(findings: DataFrame) -> DataFrame:
    """One row for each finding, whatever the number of parts its list has."""
    return findings.where(F.col("part") == 1) if "part" in findings.columns else findings
