"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions._column import col


def year_of(c) -> Column:
    return F.year(col(c))


def to_date_value(c, fmt: str | None = None, strict: bool = True) -> Column:
    """ISO text (or text in ``fmt``) to a date; bad text raises unless not strict."""
    c = col(c)
    if strict:
        return F.to_date(c, fmt) if fmt else F.to_date(c)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def iso_date(c) -> Column:
    """A date or timestamp as ISO text."""
    return F.date_format(col(c), "yyyy-MM-dd")
