"""Data-quality checks for long tables of reported values and for event records, as Spark plans."""

from plumbrow.settings import Settings

__all__ = ["Settings"]
