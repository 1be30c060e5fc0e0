"""The first uid of each group that a check flags.

A minimum of texts makes an aggregate sort its rows. So the checks count and compare with numbers
only, which hashes, and look up the uids of the few groups they flag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.functions.keys import join_same
from plumbrow.sources.staging import stage


def with_first_uid(flagged: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The flagged groups, stored, with the smallest uid of their rows."""
    flagged = stage(flagged, "flagged-groups")
    of_flagged = join_same(rows.select(*keys, "uid"), flagged.select(*keys), keys, "left_semi")
    uids = of_flagged.groupBy(*keys).agg(F.min("uid").alias("uid"))
    return join_same(flagged, uids, keys)
