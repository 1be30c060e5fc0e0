"""Every threshold and word list a check reads, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

# Entries of the units column that are not units of measure.
NON_UNITS = (
    "text input",
    "text_input",
    "[Select one]",
    "0=No 1=Yes",
    "No/New/Stopped/Other",
    "no unit",
)

# Words that are units as well as labels.
UNIT_WORDS = ("index", "value", "number", "years", "hours", "days")


@dataclass(frozen=True)
class Settings:
    # mapping
    min_disclosure_year: int = 2013
    # units
    non_units: tuple[str, ...] = NON_UNITS
    allowed_words: tuple[str, ...] = UNIT_WORDS
    # series
    series_min_years: int = 4
    # schedules
    blank_min_rows: int = 20
    blank_share: float = 0.8
    gap_peer_share: float = 0.75
    gap_min_peers: int = 5
    drop_share: float = 0.25
    drop_min_years: int = 3
    # reconciliation, in percent
    tolerance_pct: float = 0.5
    # Members in one part of a list column; longer lists have several parts.
    list_part: int = 10_000
    # Groups with more rows than this take the distributed median.
    hot_group_rows: int = 100_000
