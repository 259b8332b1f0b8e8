"""Window columns, and the same results without a window where one task would
get too many rows.

A window without ``PARTITION BY`` puts all rows in one task, and a window over
a hot group puts that group in one task. The named operators below avoid both:

* ``group_measures`` aggregates and joins back;
* ``rank_rows`` ranks the distinct values and joins back;
* ``number_rows`` and ``running_total`` use a plain window for groups whose
  counted size is small, and range partitions with offsets for the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import SINGLE_TASK_ROWS, stage

_PART, _START, _ROW, _LOCAL, _TIE = "__part", "__start", "__row", "__local", "__tie"
_LOW_BITS = 2**33 - 1
# Up to so many offsets are broadcast; more are joined by a shuffle.
MAX_OFFSETS = 500_000


def window_columns(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add ``{name: "... OVER (...)"}`` columns, written as Spark SQL.

    Passed to Spark as they are; give each window a ``PARTITION BY`` whose
    groups fit a task, or use the operators below.
    """
    return df.selectExpr("*", *[f"{e} AS `{n}`" for n, e in expressions.items()])


def order_column(spec: str | Column) -> Column:
    """``"price desc"`` or ``"name"`` as a sort column; nulls always last."""
    if isinstance(spec, Column):
        return spec
    name, _, direction = spec.partition(" ")
    if direction.strip().lower() not in ("", "asc", "desc"):
        raise ValueError(f"unknown sort direction in {spec!r}")
    c = F.col(name)
    return c.desc_nulls_last() if direction.strip().lower() == "desc" else c.asc_nulls_last()


def group_measures(
    df: DataFrame, keys: str | Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """Give every row the aggregates of its group, ``{name: SQL aggregate}``.

    Equal to ``agg OVER (PARTITION BY keys)``, but the groups are reduced before
    the shuffle and only one row per group is joined back, so a hot group costs
    no more than any other. Null keys form a group, as in a window.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    reduced = df.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(
        *[F.expr(e).alias(n) for n, e in measures.items()]
    )
    same = reduce(
        lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    )
    return df.join(reduced, same, "left").drop(*names.values())


def rank_rows(
    df: DataFrame,
    column: str,
    target: str,
    descending: bool = True,
    row_bound: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """``RANK()`` over all rows, as long: ties share a rank and gaps follow.

    ``row_bound`` is a known upper bound of the row count; without it the rows
    are counted. Up to ``single_task_rows`` rows a plain window is used. Beyond,
    the distinct values are counted (ties fold before the shuffle), their
    running total gives each value its rank, and the ranks are joined back.
    """
    direction = "desc" if descending else "asc"
    if row_bound is None:
        row_bound = df.count()
    if row_bound <= single_task_rows:
        order = Window.orderBy(order_column(f"{column} {direction}"))
        return df.withColumn(target, F.rank().over(order).cast("long"))
    values = df.groupBy(F.col(column).alias("__value")).agg(
        F.count(F.lit(1)).alias("__ties")
    )
    values = stage(values.withColumn("__seen", F.col("__ties")), "rank-values")
    seen = _prefix_sums(values, f"__value {direction}", ["__seen"], [], single_task_rows)
    ranked = seen.select("__value", (F.col("__seen") - F.col("__ties") + 1).alias(target))
    return df.join(ranked, F.col(column).eqNullSafe(F.col("__value")), "left").drop("__value")


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    target: str,
    partition_by: Sequence[str] = (),
    row_bound: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    unique: bool = True,
) -> DataFrame:
    """``ROW_NUMBER()`` over all rows or within groups.

    ``order_by`` should end in a unique column, so that the numbers do not
    depend on chance and a value shared by many rows can still be split. Where
    many rows may be equal in all of ``order_by``, ``unique=False`` stores them
    with a tie-break first. ``row_bound`` is a known upper bound of the row
    count; without it the groups are counted, so pass a stored or staged table.

    Groups above ``single_task_rows`` rows are range-partitioned by the whole
    sort key and sorted. The row position inside each partition comes from
    ``monotonically_increasing_id``; the partitions before it add an offset.
    """
    cold, hot, hot_groups = _split_hot(df, partition_by, single_task_rows, row_bound)
    parts = []
    if cold is not None:
        window = Window.partitionBy(*partition_by).orderBy(*[order_column(o) for o in order_by])
        parts.append(cold.withColumn(target, F.row_number().over(window).cast("long")))
    if hot is not None:
        sort = [F.col(g).asc_nulls_last() for g in partition_by]
        sort += [order_column(o) for o in order_by]
        if not unique:
            # stored, so that a task that runs again meets the same tie-break
            hot = stage(hot.withColumn(_TIE, F.monotonically_increasing_id()), "ties")
            sort.append(F.col(_TIE))
        ranged = (
            hot.repartitionByRange(_tasks(df), *sort)
            .sortWithinPartitions(*sort)
            .withColumn(_ROW, F.monotonically_increasing_id())
        )
        ranged = stage(ranged, "number-rows").withColumns(
            {_PART: F.shiftrightunsigned(_ROW, 33), _ROW: F.col(_ROW).bitwiseAND(F.lit(_LOW_BITS))}
        )
        # one row for each partition and for each hot group it holds
        pieces = ranged.groupBy(*partition_by, _PART).agg(
            F.min(_ROW).alias(_START), F.count(F.lit(1)).alias(_LOCAL)
        )
        offsets = _with_offsets(pieces, partition_by, [_LOCAL])
        numbered = _join_pieces(ranged, offsets, partition_by, hot_groups)
        parts.append(
            numbered.withColumn(
                target, F.col(_ROW) - F.col(_START) + 1 + F.coalesce(_LOCAL, F.lit(0))
            ).select(*df.columns, target)
        )
    return reduce(DataFrame.unionByName, parts)


def running_total(
    df: DataFrame,
    order_by: str,
    measures: Mapping[str, str],
    partition_by: Sequence[str] = (),
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """``SUM(x) OVER (PARTITION BY … ORDER BY y)`` with the default frame.

    ``measures`` maps new names to numeric columns. Rows with an equal order
    value share the total, so the sums are first folded to one row for each
    order value; their running totals are then joined back.
    """
    name = order_by.partition(" ")[0]
    keys = [*partition_by, name]
    key_names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    folded = df.groupBy(*[F.col(k).alias(n) for k, n in key_names.items()]).agg(
        *[F.sum(c).alias(t) for t, c in measures.items()]
    )
    groups = [key_names[g] for g in partition_by]
    order = order_by.replace(name, key_names[name], 1)
    totals = _prefix_sums(
        stage(folded, "running-total"), order, list(measures), groups, single_task_rows
    )
    same = reduce(
        lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in key_names.items()]
    )
    return df.join(totals, same, "left").select(*df.columns, *measures)


def _prefix_sums(df, order, columns, groups, single_task_rows):
    """Running sums over rows whose order value is unique within the group."""
    cold, hot, hot_groups = _split_hot(df, groups, single_task_rows)
    frame = (Window.unboundedPreceding, Window.currentRow)
    parts = []
    if cold is not None:
        window = Window.partitionBy(*groups).orderBy(order_column(order)).rowsBetween(*frame)
        parts.append(cold.withColumns({c: F.sum(c).over(window) for c in columns}))
    if hot is not None:
        sort = [F.col(g).asc_nulls_last() for g in groups] + [order_column(order)]
        ranged = stage(
            hot.repartitionByRange(_tasks(df), *sort).withColumn(_PART, F.spark_partition_id()),
            "prefix-sums",
        )
        pieces = ranged.groupBy(*groups, _PART).agg(
            *[F.sum(c).alias(f"__before_{i}") for i, c in enumerate(columns)]
        )
        before = [f"__before_{i}" for i in range(len(columns))]
        window = (
            Window.partitionBy(_PART, *groups).orderBy(order_column(order)).rowsBetween(*frame)
        )
        local = ranged.withColumns({c: F.sum(c).over(window) for c in columns})
        joined = _join_pieces(local, _with_offsets(pieces, groups, before), groups, hot_groups)
        sums = {
            c: F.when(F.col(b).isNull(), F.col(c))
            .when(F.col(c).isNull(), F.col(b))
            .otherwise(F.col(c) + F.col(b))
            for c, b in zip(columns, before)
        }
        parts.append(joined.withColumns(sums).select(*df.columns))
    return reduce(DataFrame.unionByName, parts)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _split_hot(df, groups, single_task_rows, row_bound=None):
    """The rows of small groups, those of large groups, and the number of the latter.

    Either part may be None. ``df`` is read for the count and for each part.
    """
    if row_bound is None and not groups:
        row_bound = df.count()
    if row_bound is not None and row_bound <= single_task_rows:
        return df, None, 0
    if not groups:
        return None, df, 1
    large = (
        df.groupBy(*[F.col(g).alias(f"__hot_{i}") for i, g in enumerate(groups)])
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > single_task_rows)
        .drop("__rows")
    )
    # each listed group stands for more than single_task_rows rows
    large = stage(large, "hot-groups")
    hot_groups = large.count()
    if hot_groups == 0:
        return df, None, 0
    same = reduce(
        lambda x, y: x & y,
        [F.col(g).eqNullSafe(F.col(f"__hot_{i}")) for i, g in enumerate(groups)],
    )
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi"), hot_groups


def _with_offsets(pieces, groups, columns):
    """Replace each column of ``pieces`` by its sum over the partitions before.

    Null where there is nothing to add up, as in a running sum.     ``pieces`` has one row for each range partition and hot group in it: at most
    the number of partitions plus the number of hot groups.
    """
    window = (
        Window.partitionBy(*groups)
        .orderBy(_PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return pieces.withColumns({c: F.sum(c).over(window) for c in columns})


def _join_pieces(rows, pieces, groups, hot_groups):
    names = {g: f"__piece_{i}" for i, g in enumerate(groups)}
    right = pieces.withColumnsRenamed({**names, _PART: "__piece_part"})
    same = reduce(
        lambda x, y: x & y,
        [F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()],
        F.col(_PART) == F.col("__piece_part"),
    )
    # one row for each partition and for each hot group that starts in it
    if _tasks(rows) + hot_groups <= MAX_OFFSETS:
        right = F.broadcast(right)
    return rows.join(right, same).drop(_PART, "__piece_part", *names.values())
