"""Contracts: declared limits on counts, checked in one aggregate.

All checks that look at single rows share one pass over the table; each
duplicate check adds one count per key. The result is a table with one row for
each check.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import stage

LIMITS = {
    "must_be": "=",
    "must_be_greater_than": ">",
    "must_be_greater_than_or_equal": ">=",
    "must_be_less_than": "<",
    "must_be_less_than_or_equal": "<=",
}
_COLUMN_CHECKS = (
    "missing",
    "missing_count",
    "missing_percent",
    "invalid",
    "invalid_count",
    "invalid_percent",
    "min",
    "max",
)
_TABLE_CHECKS = ("row_count", "duplicate", "freshness")
_DURATION = re.compile(
    r"^P(?:(?P<weeks>\d+)W)?(?:(?P<days>\d+)D)?"
    r"(?:T(?:(?P<hours>\d+)H)?(?:(?P<minutes>\d+)M)?(?:(?P<seconds>\d+)S)?)?$"
)


def parse_duration(text: str) -> timedelta:
    """An ISO-8601 duration of weeks, days and times, such as ``P1D`` or ``PT6H``."""
    match = _DURATION.match(text)
    if not match or not any(match.groups()):
        raise ValueError(f"not an ISO-8601 duration: {text!r}")
    return timedelta(**{k: int(v) for k, v in match.groupdict().items() if v})


@dataclass(frozen=True)
class Check:
    """One limit. ``limit`` is a pair such as ``("=", 0)``."""

    kind: str
    columns: tuple[str, ...] = ()
    limit: tuple[str, float] = ("=", 0)
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}({', '.join(self.columns)})" if self.columns else self.kind

    @property
    def limit_text(self) -> str:
        if self.kind == "freshness":
            return f"<= {self.options['freshness_limit']}"
        return f"{self.limit[0]} {self.limit[1]}"


@dataclass(frozen=True)
class Contract:
    dataset: str
    checks: tuple[Check, ...]

    @classmethod
    def from_dict(cls, spec: Mapping) -> Contract:
        """The parsed form of a contract file: ``dataset``, ``columns``, ``checks``."""
        found = []
        for column in spec.get("columns", ()):
            for entry in column.get("checks") or ():
                for kind, body in entry.items():
                    if kind not in _COLUMN_CHECKS:
                        raise ValueError(f"unknown column check {kind!r}")
                    found.append(_check(kind, (column["name"],), body or {}))
        for entry in spec.get("checks", ()):
            for kind, body in entry.items():
                if kind not in _TABLE_CHECKS:
                    raise ValueError(f"unknown table check {kind!r}")
                body = dict(body or {})
                columns = tuple(body.pop("columns", ()))
                if kind == "freshness":
                    columns = (body.pop("column"),)
                found.append(_check(kind, columns, body))
        return cls(spec["dataset"], tuple(found))

    @classmethod
    def from_yaml(cls, text: str) -> Contract:
        """A contract from YAML text; needs the optional ``yaml`` module."""
        import yaml

        return cls.from_dict(yaml.safe_load(text))


def _check(kind: str, columns: tuple[str, ...], body: Mapping) -> Check:
    limits = [(LIMITS[k], v) for k, v in body.items() if k in LIMITS]
    if len(limits) > 1:
        raise ValueError(f"{kind} has more than one limit")
    options = {k: v for k, v in body.items() if k not in LIMITS}
    unknown = set(options) - {
        "valid_min",
        "valid_max",
        "valid_values",
        "freshness_limit",
        "fail_when_missing",
    }
    if unknown:
        raise ValueError(f"{kind} has unknown settings: {', '.join(sorted(unknown))}")
    return Check(kind, columns, limits[0] if limits else ("=", 0), options)


def checks_from_lists(
    dataset: str,
    required: Sequence[str] = (),
    positive: Sequence[str] = (),
    allowed: Mapping[str, Sequence] | None = None,
    min_rows: int = 1,
) -> Contract:
    """A contract from the usual lists."""
    checks = [Check("row_count", limit=(">=", min_rows))]
    checks += [Check("missing_count", (c,)) for c in required]
    checks += [Check("min", (c,), (">", 0)) for c in positive]
    checks += [
        Check("invalid_count", (c,), options={"valid_values": list(v)})
        for c, v in (allowed or {}).items()
    ]
    return Contract(dataset, tuple(checks))


def invalid_value(check: Check) -> Column:
    """True for a value outside the declared set; null is missing, not invalid."""
    value, options = F.col(check.columns[0]), check.options
    tests = []
    if "valid_min" in options:
        tests.append(value < F.lit(options["valid_min"]))
    if "valid_max" in options:
        tests.append(value > F.lit(options["valid_max"]))
    if "valid_values" in options:
        tests.append(~value.isin(*options["valid_values"]))
    if not tests:
        raise ValueError(f"{check.name} declares no valid values")
    return reduce(lambda x, y: x | y, tests)


def age_in_seconds(newest: Column, now: datetime | None) -> Column:
    """Seconds from ``newest``, seconds themselves, to ``now``."""
    if now is None:
        raise ValueError("a freshness check needs the time to compare with (now=…)")
    # a time without a zone is one of the session's, like those in the table
    given = F.lit(now) if now.tzinfo else F.lit(now.isoformat(" "))
    return given.cast("timestamp").cast("double") - newest


def _metric(check: Check, now: datetime | None) -> Column:
    rows = F.count(F.lit(1))
    if check.kind == "row_count":
        return rows
    value = F.col(check.columns[0])
    kind = check.kind.removesuffix("_count")
    if kind == "missing":
        return F.count_if(value.isNull())
    if kind == "invalid":
        return F.count_if(invalid_value(check))
    if kind in ("missing_percent", "invalid_percent"):
        bad = value.isNull() if kind == "missing_percent" else invalid_value(check)
        return F.coalesce(F.count_if(bad) * 100.0 / F.nullif(rows, F.lit(0)), F.lit(0.0))
    if kind in ("min", "max"):
        return F.min(value) if kind == "min" else F.max(value)
    if kind == "freshness":
        return age_in_seconds(F.max(value.cast("timestamp")).cast("double"), now)
    raise ValueError(f"unknown check {check.kind!r}")


def _passed(check: Check, value: Column) -> Column:
    if check.kind == "freshness":
        limit = parse_duration(check.options["freshness_limit"]).total_seconds()
        missing_passes = not check.options.get("fail_when_missing", False)
        return F.coalesce(value <= F.lit(limit), F.lit(missing_passes))
    op, limit = check.limit
    compared = {
        "=": value == F.lit(limit),
        ">": value > F.lit(limit),
        ">=": value >= F.lit(limit),
        "<": value < F.lit(limit),
        "<=": value <= F.lit(limit),
    }[op]
    # the extreme of no values at all breaks no limit
    return F.coalesce(compared, F.lit(check.kind in ("min", "max")))


def check_line(check: Check, value: Column) -> Column:
    """The result of a check as a struct: check_name, value, limit, passed."""
    return F.struct(
        F.lit(check.name).alias("check_name"),
        value.cast("double").alias("value"),
        F.lit(check.limit_text).alias("limit"),
        _passed(check, value.cast("double")).alias("passed"),
    )


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key that another row has. Null is no key."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))
    )


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The keys that more than one row has, with their numbers of rows."""
    counts = df.dropna(subset=list(columns)).groupBy(*columns)
    return counts.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def run_contract(
    df: DataFrame, contract: Contract, now: datetime | None = None, stored: bool = False
) -> DataFrame:
    """One row for each check: check_name, value, limit, passed.

    All checks but those of duplicates are taken in one pass, and each of the
    latter needs one of its own. With ``stored``, the input is a table that is
    cheap to read again: it is scanned for each, only the columns that it needs.
    Any other input is computed once and stored before.
    """
    single = [c for c in contract.checks if c.kind != "duplicate"]
    passes = len(contract.checks) - len(single) + bool(single)
    if passes > 1 and not stored:
        df = stage(df, "checked")
    results = []
    if single:
        metrics = df.agg(*[_metric(c, now).alias(f"m{i}") for i, c in enumerate(single)])
        lines = F.array(*[check_line(c, F.col(f"m{i}")) for i, c in enumerate(single)])
        results.append(metrics.select(F.inline(lines)))
    for check in contract.checks:
        if check.kind == "duplicate":
            counted = duplicate_count(df, check.columns)
            results.append(counted.select(F.inline(F.array(check_line(check, F.col("duplicates"))))))
    if not results:
        raise ValueError(f"contract '{contract.dataset}' has no checks")
    return reduce(DataFrame.unionByName, results)


def contract_totals(results: DataFrame) -> DataFrame:
    """One row: how many checks ran, passed and failed, and whether all passed."""
    return results.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.every("passed").alias("passed"),
    )
