"""Date helpers used by the bronze and quarantine columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_text(c: Column | str) -> Column:
    """``yyyy-MM`` text of a date or timestamp."""
    return F.date_format(c, "yyyy-MM")


def month_start(text: Column | str) -> Column:
    """``yyyy-MM`` text → DATE of the first day of that month."""
    return F.to_date(text, "yyyy-MM")


def day(c: Column | str) -> Column:
    return F.to_date(c)
