"""Conditional, arithmetic and cast columns."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions._column import col, value_of

COMPARISONS = {
    ">=": operator.ge,
    ">": operator.gt,
    "<=": operator.le,
    "<": operator.lt,
    "==": operator.eq,
    "!=": operator.ne,
}

# Price tiers and their upper bounds in whole dollars.
TIER_NAMES = ("budget", "mid", "premium")
TIER_BOUNDS = (500_000, 3_000_000)


def compare(c, op: str, value) -> Column:
    """``c op value`` for one of six operators."""
    if op not in COMPARISONS:
        raise ValueError(f"unknown operator {op!r}; use one of {', '.join(COMPARISONS)}")
    return COMPARISONS[op](col(c), value_of(value))


def fill_empty(c, *fallbacks) -> Column:
    """The first non-null of the column and its fallbacks.

    A Column is used as it is; any other fallback is a constant.
    """
    return F.coalesce(col(c), *[value_of(f) for f in fallbacks])


def is_empty(c) -> Column:
    """Null. An empty string is a value."""
    return col(c).isNull()


def is_not_empty(c) -> Column:
    return col(c).isNotNull()


def flag_when(condition: Column | str) -> Column:
    """A boolean from a condition, given as a Column or as SQL text."""
    return F.expr(condition) if isinstance(condition, str) else condition


def extract_when(*branches: tuple[Column, object], default=None) -> Column:
    """The value of the first branch whose condition holds, else ``default``."""
    if not branches:
        raise ValueError("extract_when needs at least one (condition, value) pair")
    condition, value = branches[0]
    result = F.when(condition, value_of(value))
    for condition, value in branches[1:]:
        result = result.when(condition, value_of(value))
    return result.otherwise(value_of(default))


def replace_when(c, op: str, value, replacement) -> Column:
    """``replacement`` where the comparison holds; nulls stay null."""
    c = col(c)
    return F.when(compare(c, op, value), value_of(replacement)).otherwise(c)


def add_number(c, number) -> Column:
    return col(c) + F.lit(number)


def subtract_number(c, number) -> Column:
    return col(c) - F.lit(number)


def price_difference(price, base) -> Column:
    return col(price) - col(base)


def percent_change(price, base, digits: int | None = 1) -> Column:
    """Change against ``base`` in percent; null when the base is null or zero."""
    price, base = col(price), col(base)
    change = (price - base) * F.lit(100.0) / F.nullif(base, F.lit(0))
    return change if digits is None else F.round(change, digits)


def price_tier(
    c,
    bounds: Sequence[float] = TIER_BOUNDS,
    names: Sequence[str] = TIER_NAMES,
    inclusive: bool = False,
) -> Column:
    """The name of the first tier whose upper bound lies above the value.

    ``inclusive`` puts a value that equals a bound in the lower tier. A null
    falls through to the last tier.
    """
    if len(names) != len(bounds) + 1:
        raise ValueError("price_tier needs one more name than bounds")
    below = operator.le if inclusive else operator.lt
    c = col(c)
    tier = F.when(below(c, F.lit(bounds[0])), names[0])
    for bound, name in zip(bounds[1:], names[1:-1]):
        tier = tier.when(below(c, F.lit(bound)), name)
    return tier.otherwise(names[-1])


def cast_column(c, data_type: str, strict: bool = True) -> Column:
    """Cast; bad text raises, or becomes null with ``strict=False``."""
    c = col(c)
    return c.cast(data_type) if strict else c.try_cast(data_type)


def scale_to_priority(df: DataFrame, c: str, low: float = 0.5, high: float = 1.0) -> Column:
    """``value / max`` scaled into [low, high].

    The maximum is a scalar subquery, so no join or collect takes place.
    """
    top = df.select(F.max(c).cast("double")).scalar()
    return F.col(c) / F.nullif(top, F.lit(0.0)) * F.lit(high - low) + F.lit(low)


def map_values(c, mapping: Mapping, default=None, keep_unmapped: bool = True) -> Column:
    """Replace values by a small literal dictionary; a value may be mapped to null.

    For a dictionary that is itself a table, join it (``operators.joins.lookup``).
    """
    c = col(c)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    other = c if keep_unmapped else value_of(default)
    if not pairs:
        return F.coalesce(F.lit(None), other)
    table = F.create_map(*pairs)
    return F.when(F.map_contains_key(table, c), F.try_element_at(table, c)).otherwise(other)


def age_in_years(year, reference_year: int) -> Column:
    """``reference_year - year``; the reference year is an argument, never the clock."""
    return F.lit(reference_year) - col(year)


def bucket_label(c, threshold, below: str, otherwise: str) -> Column:
    """``below`` under the threshold, else ``otherwise`` (also for null)."""
    return F.when(col(c) < F.lit(threshold), below).otherwise(otherwise)
