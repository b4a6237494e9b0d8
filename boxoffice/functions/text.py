"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Trimmed, each space-separated word capitalised."""
    return F.initcap(F.trim(text))


def upper_code(text: Column) -> Column:
    """Trimmed and upper-cased: codes, countries, platform names."""
    return F.upper(F.trim(text))


def lower_code(text: Column) -> Column:
    """Trimmed and lower-cased: statuses."""
    return F.lower(F.trim(text))
