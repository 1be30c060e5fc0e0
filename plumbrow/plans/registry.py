"""The thirteen table checks with their severity, tags and the relation each one reads."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from plumbrow.operators.coverage import (
    blank_schedule,
    row_count_drop,
    schedule_gap,
    schedule_sizes,
    year_gap,
)
from plumbrow.operators.rows import ambiguous_rows, cell_repeats, duplicate_rows
from plumbrow.operators.series import uneven_series_values
from plumbrow.operators.units import (
    unit_usage,
    units_across_years,
    units_are_units,
    units_within_year,
)
from plumbrow.operators.values import (
    judged_values,
    magnitude_outlier,
    percent_as_proportion,
    scale_break,
    sign_flip,
    suspect_values,
)
from plumbrow.settings import Settings
from plumbrow.sources.staging import in_same_scope, stage

WARN, ERROR = "warn", "error"

log = logging.getLogger(__name__)

JOBS_AT_ONCE = 4


class CheckInputs:
    """Standard rows and the relations derived from them, each built when first asked for.

    With `shared`, the suspect values are stored as well, so that the mart is shuffled once for all
    checks on series.
    """

    def __init__(self, rows: DataFrame, settings: Settings = Settings(), shared: bool = False):
        self.rows = rows
        self.settings = settings
        self._shared = shared

    @cached_property
    def sizes(self) -> DataFrame:
        return schedule_sizes(self.rows)

    @cached_property
    def usage(self) -> DataFrame:
        return unit_usage(self.rows, self.settings)

    @cached_property
    def repeats(self) -> DataFrame:
        return cell_repeats(self.rows)

    @cached_property
    def judged(self) -> DataFrame:
        series = uneven_series_values(self.rows, self.settings)
        if self._shared:
            return stage(suspect_values(series), "suspect-values")
        return judged_values(series)


@dataclass(frozen=True)
class Check:
    name: str
    reads: tuple[str, ...]
    find: Callable[..., DataFrame]
    severity: str = WARN
    tags: tuple[str, ...] = ("data_quality",)

    def run(self, inputs: CheckInputs) -> DataFrame:
        return self.find(*[getattr(inputs, name) for name in self.reads], inputs.settings)

    def test_name(self, sector: str) -> str:
        """The check as attached to one sector's mart; also the name of its findings table."""
        return f"{sector}_dq_{self.name}"


CHECKS = (
    Check("duplicate_rows", ("repeats",), duplicate_rows),
    Check("ambiguous_rows", ("repeats",), ambiguous_rows, ERROR),
    Check("scale_break", ("judged",), scale_break),
    Check("magnitude_outlier", ("judged",), magnitude_outlier),
    Check("sign_flip", ("judged",), sign_flip),
    Check("percent_as_proportion", ("rows",), percent_as_proportion),
    Check("units_within_year", ("usage", "rows"), units_within_year),
    Check(
        "units_across_years",
        ("usage", "rows"),
        units_across_years,
        tags=("data_quality", "informational"),
    ),
    Check("units_are_units", ("rows",), units_are_units),
    Check("blank_schedule", ("sizes", "rows"), blank_schedule),
    Check("schedule_gap", ("sizes",), schedule_gap),
    Check("row_count_drop", ("sizes", "rows"), row_count_drop),
    Check("year_gap", ("sizes",), year_gap),
)


def run_checks(inputs: CheckInputs, checks: Sequence[Check] = CHECKS) -> list[DataFrame]:
    """The findings of several checks, in their order.

    Relations that do not depend on each other are stored at the same time, so the cluster has
    work while one job waits for its last tasks.
    """
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        prepare(inputs, checks, pool)
        return list(pool.map(in_same_scope(lambda check: check.run(inputs)), checks))


def prepare(inputs: CheckInputs, checks: Sequence[Check], pool: ThreadPoolExecutor) -> None:
    """Build the relations the checks read. One that fails is tried again by the checks on it."""

    def build(name: str) -> None:
        try:
            getattr(inputs, name)
        except Exception:
            log.exception("building %s failed", name)

    list(pool.map(in_same_scope(build), dict.fromkeys(name for check in checks for name in check.reads)))


def find_check(name: str) -> Check:
    for check in CHECKS:
        if check.name == name:
            return check
    raise ValueError(f"no check {name!r}; checks: {', '.join(c.name for c in CHECKS)}")


def select_checks(
    names: tuple[str, ...] | None = None, tags: tuple[str, ...] | None = None
) -> list[Check]:
    """The checks of the given names, or carrying any of the given tags; all by default."""
    chosen = list(CHECKS) if names is None else [find_check(n) for n in names]
    return chosen if tags is None else [c for c in chosen if set(tags) & set(c.tags)]
