"""Group-by operators. Counts, sums and extremes are reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.windows import group_measures, number_rows


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def aggregate(
    df: DataFrame, keys: str | Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """``{name: SQL aggregate}`` per group; no keys gives one row."""
    exprs = [F.expr(e).alias(n) for n, e in measures.items()]
    if not exprs:
        raise ValueError("aggregate needs at least one measure")
    keys = _keys(keys)
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)


def sales_per_item(
    sales: DataFrame,
    item_key: str,
    price: str,
    date: str,
    digits: int | None = 0,
    iso_text: bool = False,
) -> DataFrame:
    """Count, total, average and first and last date of the sales of each item.

    Dates are compared as they are. Text can only be compared in an aggregate
    that sorts all rows by key; where the dates are known to be ISO text of ten
    characters, ``iso_text`` compares them as dates in a hash aggregate and gives
    them back as text. Any other text then raises.
    """
    average = F.avg(price)
    value = F.col(date)
    if iso_text:
        wrong = F.raise_error(F.concat(F.lit("not an ISO date: "), value)).cast("date")
        value = F.when(value.isNull() | (F.length(value) == 10), value.cast("date")).otherwise(wrong)
    first, last = F.min(value), F.max(value)
    if iso_text:
        first, last = first.cast("string"), last.cast("string")
    return sales.groupBy(item_key).agg(
        F.count(F.lit(1)).alias("sale_count"),
        F.sum(price).alias("total_sales_value"),
        (average if digits is None else F.round(average, digits)).alias("avg_sale_price"),
        first.alias("first_sale_date"),
        last.alias("last_sale_date"),
    )


def ordered_structs(
    df: DataFrame, keys: str | Sequence[str], order_by: str, fields: Sequence[str], target: str
) -> DataFrame:
    """One list of structs per group, ordered by a column.

    The order column leads the struct that is sorted, nulls last; ties follow
    the fields. The result is one cell per group: where a group may be too large
    for that use ``ordered_struct_parts``.
    """
    return df.groupBy(*_keys(keys)).agg(struct_list(order_by, fields).alias(target))


def struct_list(order_by: str, fields: Sequence[str]) -> Column:
    """The aggregate behind ``ordered_structs``."""
    return sorted_items(F.col(order_by), F.struct(*fields))


def sorted_items(order: Column, item: Column) -> Column:
    """The collected items, sorted by ``order`` with nulls last, then by themselves."""
    entry = F.struct(
        order.isNull().alias("last"),
        order.alias("order"),
        item.isNull().alias("empty"),
        item.alias("item"),
    )
    return F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["item"])


def ordered_struct_parts(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str],
    fields: Sequence[str],
    target: str,
    part_rows: int = 10_000,
    **kwargs,
) -> DataFrame:
    """Like ``ordered_structs``, in parts of at most ``part_rows`` elements.

    Each row is ``(keys, part, list)`` with parts counted from 0, so a group of
    any size stays whole without ever being one cell or one task. ``order_by``
    must end in a unique column.
    """
    return _in_parts(df, keys, order_by, F.struct(*fields), target, part_rows, kwargs)


def _in_parts(df, keys, order_by, item: Column, target, part_rows, options) -> DataFrame:
    keys = _keys(keys)
    numbered = number_rows(df, order_by, "__position", keys, **options)
    part = F.floor((F.col("__position") - 1) / part_rows).cast("long")
    items = sorted_items(F.col("__position"), item)
    return numbered.withColumn("part", part).groupBy(*keys, "part").agg(items.alias(target))


def list_parts(
    df: DataFrame,
    keys: str | Sequence[str],
    column: str,
    order_by: Sequence[str],
    target: str,
    part_rows: int = 10_000,
    **kwargs,
) -> DataFrame:
    """Like ``implode`` and ``ordered_list``, in parts as in ``ordered_struct_parts``."""
    return _in_parts(df, keys, order_by, F.col(column), target, part_rows, kwargs)


def text_parts(
    df: DataFrame,
    keys: str | Sequence[str],
    column: str,
    order_by: Sequence[str],
    target: str,
    sep: str = ", ",
    part_rows: int = 10_000,
    **kwargs,
) -> DataFrame:
    """Like ``ordered_text``, in parts: the parts of a group, joined by ``sep``, are its text.

    Null values are left out; a part that has no others is null.
    """
    lists = list_parts(df, keys, column, order_by, "__items", part_rows, **kwargs)
    there = F.filter("__items", lambda x: x.isNotNull())
    text = F.when(F.size(there) > 0, F.array_join(there, sep))
    return lists.select(*_keys(keys), "part", text.alias(target))


def first_where(
    df: DataFrame,
    keys: str | Sequence[str],
    values: Mapping[str, str],
    condition: str,
    order_by: Sequence[str],
) -> DataFrame:
    """The values of the first row per group that meets the condition.

    All values come from the same row. Groups without such a row are kept, with
    nulls. ``values`` maps new names to columns.
    """
    first = first_match(values, condition, order_by).alias("__first")
    return df.groupBy(*_keys(keys)).agg(first).select(
        *_keys(keys), *[F.col(f"__first.{n}").alias(n) for n in values]
    )


def first_match(
    values: Mapping[str, str], condition: str, order_by: Sequence[str]
) -> Column:
    """The aggregate behind ``first_where``: a struct of the picked values."""
    picked = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    order = F.when(F.expr(condition), F.struct(*[F.col(o) for o in order_by]))
    return F.min_by(picked, order)


def implode(
    df: DataFrame, keys: str | Sequence[str], column: str, order_by: str | None = None
) -> DataFrame:
    """The values of a column as a list per group; nulls stay in the list.

    The list follows ``order_by``, or the values themselves.
    """
    items = sorted_items(F.col(order_by or column), F.col(column))
    return df.groupBy(*_keys(keys)).agg(items.alias(column))


def ordered_list(
    df: DataFrame, keys: str | Sequence[str], column: str, order_by: str, target: str
) -> DataFrame:
    """The values of one column as a list per group, ordered by another column."""
    return implode(df, keys, column, order_by).withColumnRenamed(column, target)


def ordered_text(
    df: DataFrame,
    keys: str | Sequence[str],
    column: str,
    order_by: Sequence[str],
    target: str,
    sep: str = ", ",
) -> DataFrame:
    """The values of a column joined to one text per group, in a given order.

    ``order_by`` holds SQL sort items such as ``year DESC``.
    """
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    text = F.expr(f"listagg({column}, '{quoted}') WITHIN GROUP (ORDER BY {', '.join(order_by)})")
    return df.groupBy(*_keys(keys)).agg(text.alias(target))


def value_counts(df: DataFrame, column: str, target: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(target))


def distinct_count(column: str | Column, count_null: bool = True) -> Column:
    """Number of distinct values; null is one of them unless told otherwise."""
    c = F.col(column) if isinstance(column, str) else column
    distinct = F.count_distinct(c)
    nulls = F.coalesce(F.max(c.isNull()), F.lit(False)).cast("int")
    return distinct + nulls if count_null else distinct


def summarise(
    df: DataFrame,
    sums: Sequence[str] = (),
    ranges: Sequence[str] = (),
    distinct: Sequence[str] = (),
    flags: Sequence[str] = (),
) -> DataFrame:
    """One row about the whole table, in one pass.

    ``sums`` are totalled, ``ranges`` give a minimum and a maximum, ``distinct``
    are counted and ``flags`` give the numbers of true and of other rows.
    """
    items = [F.count(F.lit(1)).alias("record_count")]
    items += [F.sum(c).alias(f"{c}_total") for c in sums]
    for c in ranges:
        items += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    items += [distinct_count(c).alias(f"{c}_distinct") for c in distinct]
    for c in flags:
        items += [F.count_if(c).alias(f"{c}_true"), F.count_if(~F.col(c)).alias(f"{c}_false")]
    return df.agg(*items)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls in each column."""
    return df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in columns or df.columns])


def group_total(df: DataFrame, keys: str | Sequence[str], column: str, target: str) -> DataFrame:
    """Give every row the total of its group."""
    return group_measures(df, keys, {target: f"sum({column})"})
