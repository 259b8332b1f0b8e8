"""Queries of this package by name, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from .common import find_package

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame."""

    def keep(function):
        @wraps(function)
        def run(spark, sf_dir):
            find_package(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep
