"""List and struct columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions._column import col


def remove_nulls(c) -> Column:
    """Drop null elements; a list left empty becomes null."""
    kept = F.array_compact(col(c))
    return F.when(F.size(kept) > 0, kept)


def first_element(c) -> Column:
    """The first element; null for an empty list."""
    return F.get(col(c), F.lit(0))


def append_columns(c, *cols) -> Column:
    """Append scalar columns in order; a null list counts as empty."""
    extra = F.array(*[col(x) for x in cols])
    return F.when(col(c).isNull(), extra).otherwise(F.concat(col(c), extra))


def append_when(condition: Column, c, value) -> Column:
    """Append one scalar where the condition holds, else leave the list alone."""
    return F.when(condition, append_columns(c, value)).otherwise(col(c))


def as_list(c) -> Column:
    """Wrap a scalar in a one-element list."""
    return F.array(col(c))


def fill_missing_list(c, *others) -> Column:
    """Replace a null list by nulls, as many as the longest other list holds."""
    lengths = [F.coalesce(F.size(col(o)), F.lit(0)) for o in others]
    # size() of a null list is null or -1, depending on the session settings
    longest = F.greatest(F.lit(0), *lengths)
    return F.coalesce(col(c), F.array_repeat(F.get(col(c), F.lit(0)), longest))


def list_of_struct(fields: Mapping[str, str]) -> Column:
    """``{new name: column}`` as a list that holds one struct."""
    return F.array(F.struct(*[F.col(c).alias(name) for name, c in fields.items()]))


def zip_structs(fields: Mapping[str, str]) -> Column:
    """Parallel lists, ``{new name: column}``, as one list of structs.

    A shorter list is padded with nulls.
    """
    names = list(fields)
    zipped = F.arrays_zip(*[F.col(fields[n]) for n in names])
    return F.transform(
        zipped,
        lambda item: F.struct(*[item.getField(fields[n]).alias(n) for n in names]),
    )


def list_length(c) -> Column:
    """Number of elements, 0 for null."""
    return F.when(col(c).isNull(), F.lit(0)).otherwise(F.size(col(c)))
