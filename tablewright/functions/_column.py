from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    """A column name or a Column."""
    return F.col(value) if isinstance(value, str) else value


def value_of(value) -> Column:
    """A Column as it is, anything else as a literal."""
    return value if isinstance(value, Column) else F.lit(value)
