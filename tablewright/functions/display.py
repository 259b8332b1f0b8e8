"""Short display text for example rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions._column import col

_SPLIT = float(2**26)


# From here on doubles are whole numbers, and the text below needs too many digits.
_LARGE = 1e15


def _fixed(value: Column, digits: int) -> Column:
    """A non-negative double with ``digits`` decimals, as C's printf writes it.

    From ``_LARGE`` on the digits that follow from the shortest text of the
    double are given, with zeros after it.

        Rounding looks at the exact binary value. That differs from rounding the
    shortest decimal text only when this text ends exactly half way, so the
    half-way case compares the exact fraction with the half-way point: a double
    splits into two parts whose products with ``2 * 10^digits`` are exact.
    """
    large, value = value, F.when(value < _LARGE, value)
    text = value.cast("decimal(38,15)")
    half_steps = F.lit(2 * 10**digits)
    doubled = text * half_steps.cast("decimal(5,0)")
    steps = F.floor(doubled).cast("decimal(38,0)")
    is_tie = (doubled == steps) & (steps % 2 == 1)

    fraction = value - F.floor(value)
    high = F.floor(fraction * _SPLIT) / _SPLIT
    low = fraction - high
    fraction_steps = (steps - F.floor(value).cast("decimal(30,0)") * half_steps).cast("double")
    scale = F.lit(float(2 * 10**digits))
    excess = low * scale - (fraction_steps - high * scale)

    lower = ((steps - 1) / 2).cast("decimal(30,0)")
    is_even = lower % 2 == 0
    whole = F.when(
        is_tie,
        F.when(excess > 0, lower + 1)
        .when(excess < 0, lower)
        .otherwise(F.when(is_even, lower).otherwise(lower + 1)),
    )
    rounded = F.when(
        is_tie, (whole.cast("decimal(30,0)") / F.lit(10**digits)).cast(f"decimal(34,{digits})")
    ).otherwise(F.round(text, digits).cast(f"decimal(34,{digits})"))
    return F.when(large < _LARGE, rounded.cast("string")).otherwise(_whole(large, digits))


def _whole(value: Column, digits: int) -> Column:
    """A large double as digits, from its shortest text ``d.dddEn``."""
    text = value.cast("string")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    places = F.substring_index(text, "E", -1).cast("int")
    figures = F.regexp_replace(mantissa, r"\.", "")
    return F.concat(F.rpad(figures, F.greatest(places + 1, F.length(figures)), F.lit("0")), F.lit("." + "0" * digits))


def display_value(c, data_type: T.DataType) -> Column:
    """A value as short text: ``$1.2M``, ``$1.5K``, ``$123.45``, ``42``, sign first.

    Whole numbers under a thousand stay plain; other types are cast to text,
    lists and structs to JSON.
    """
    c = col(c)
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    whole = isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if not whole and not isinstance(data_type, (T.FloatType, T.DoubleType)):
        return c.cast("string")
    number = c.cast("double")
    size = F.abs(number)
    sign = F.when(number < 0, "-").otherwise("")
    small = c.cast("string") if whole else F.concat(sign, F.lit("$"), _fixed(size, 2))
    text = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(size >= 1_000_000, F.concat(sign, F.lit("$"), _fixed(size / 1_000_000, 1), F.lit("M")))
        .when(size >= 1_000, F.concat(sign, F.lit("$"), _fixed(size / 1_000, 1), F.lit("K")))
        .otherwise(small)
    )
    if whole:
        return text
    return (
        F.when(F.isnan(number), F.lit("$nan"))
        .when(size == float("inf"), F.concat(sign, F.lit("$infM")))
        .otherwise(text)
    )
