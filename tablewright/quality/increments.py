"""Contracts on tables that grow: a state for each slice, merged without reading the slices again.

A state has one row for each check, and for a duplicate check one for each key,
which stands there as 128 hash bits. States add up: the state of a table is the
merge of those of its slices, whatever the slices are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.aggregates import quoted
from tablewright.quality.contracts import Check, Contract, age_in_seconds, check_line, invalid_value

STATE_SCHEMA = "check int, k1 long, k2 long, rows long, bad long, low double, high double"


def _state_of(check: Check, number: int) -> Column:
    """The state of a check that looks at single rows."""
    low = high = F.lit(None).cast("double")
    bad = F.lit(0)
    kind = check.kind.removesuffix("_count").removesuffix("_percent")
    if check.kind != "row_count":
        value = F.col(check.columns[0])
        if kind == "missing":
            bad = F.count_if(value.isNull())
        elif kind == "invalid":
            bad = F.count_if(invalid_value(check))
        elif kind == "min":
            low = F.min(value).cast("double")
        elif kind == "max":
            high = F.max(value).cast("double")
        elif kind == "freshness":
            high = F.max(value.cast("timestamp")).cast("double")
        else:
            raise ValueError(f"unknown check {check.kind!r}")
    none = F.lit(None).cast("long")
    return F.struct(
        F.lit(number).alias("check"), none.alias("k1"), none.alias("k2"), F.count(F.lit(1)).alias("rows"),
        bad.cast("long").alias("bad"), low.alias("low"), high.alias("high"),
    )


def contract_state(df: DataFrame, contract: Contract) -> DataFrame:
    """The state of a slice, as ``STATE_SCHEMA``: one pass for all row checks, one for each duplicate check."""
    if not contract.checks:
        raise ValueError(f"contract '{contract.dataset}' has no checks")
    numbered = list(enumerate(contract.checks))
    single = [_state_of(c, n) for n, c in numbered if c.kind != "duplicate"]
    parts = []
    if single:
        parts.append(df.agg(*[s.alias(f"s{i}") for i, s in enumerate(single)]).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(single))]))))
    for number, check in numbered:
        if check.kind == "duplicate":
            columns = [quoted(c) for c in check.columns]
            keys = df.dropna(subset=list(check.columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
            none = F.lit(None).cast("double")
            parts.append(
                keys.select(
                    F.lit(number).alias("check"), F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *columns).alias("k2"),
                    "rows", F.lit(0).cast("long").alias("bad"), none.alias("low"), none.alias("high"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def merge_states(states: DataFrame) -> DataFrame:
    """One state of many: a table that holds several adds them up, in any order and any grouping."""
    return states.groupBy("check", "k1", "k2").agg(
        F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def judge_state(state: DataFrame, contract: Contract, now: datetime | None = None) -> DataFrame:
    """check_name, value, limit, passed: the rows that ``run_contract`` gives for the whole table."""
    extra = F.sum("rows") - F.count("k1")  # rows that repeat a key; nothing for other checks, which have no keys
    whole = merge_states(state).groupBy("check").agg(
        F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), F.min("low").alias("low"), F.max("high").alias("high"), extra.alias("extra")
    )
    # a slice without keys leaves no row, and a check without rows still has a result
    numbers = state.sparkSession.range(len(contract.checks)).select(F.col("id").cast("int").alias("check"))
    held = numbers.join(F.broadcast(whole), "check", "left")
    rows, bad = (F.coalesce(c, F.lit(0)) for c in ("rows", "bad"))
    lines = None
    for number, check in enumerate(contract.checks):
        if check.kind == "row_count":
            value = rows
        elif check.kind == "duplicate":
            value = F.coalesce("extra", F.lit(0))
        elif check.kind.endswith("_percent"):
            value = F.coalesce(bad * 100.0 / F.nullif(rows, F.lit(0)), F.lit(0.0))
        elif check.kind in ("min", "max"):
            value = F.col("low" if check.kind == "min" else "high")
        elif check.kind == "freshness":
            value = age_in_seconds(F.col("high"), now)
        else:
            value = bad
        line = check_line(check, value)
        lines = F.when(F.col("check") == number, line) if lines is None else lines.when(F.col("check") == number, line)
    return held.select(lines.alias("line")).select("line.*")


@dataclass(frozen=True)
class ContractStates:
    """States of the slices of one table, a folder for each under ``path``."""

    spark: SparkSession
    path: str
    contract: Contract

    def add(self, name: str, df: DataFrame) -> None:
        """Keep the state of the slice ``name``; a slice that comes again takes its own place."""
        contract_state(df, self.contract).write.mode("overwrite").parquet(f"{self.path}/slice={name}")

    def result(self, now: datetime | None = None, slices: Sequence[str] | None = None) -> DataFrame:
        """The contract's rows for all slices, or for those named, from their states alone."""
        state = self.spark.read.schema(STATE_SCHEMA + ", slice string").parquet(self.path)
        if slices is not None:
            state = state.filter(F.col("slice").isin(*slices))
        return judge_state(state.drop("slice"), self.contract, now)
