"""Errors raised before any Spark job starts."""

from __future__ import annotations

from collections.abc import Iterable


class TableError(ValueError):
    """Base class for problems with the shape or place of an input."""


class MissingTable(TableError):
    def __init__(self, caller: str, table: str, available: Iterable[str]):
        self.caller, self.table, self.available = caller, table, sorted(available)
        known = ", ".join(self.available) or "none"
        super().__init__(f"[{caller}] table '{table}' not found; available tables: {known}")


class MissingColumn(TableError):
    def __init__(self, caller: str, missing: Iterable[str], available: Iterable[str]):
        self.caller, self.missing, self.available = caller, sorted(missing), list(available)
        super().__init__(
            f"[{caller}] missing columns: {', '.join(self.missing)}; "
            f"available columns: {', '.join(self.available)}"
        )


class CheckFailed(RuntimeError):
    """A blocking check did not pass, so the dependent write was not started."""

    def __init__(self, name: str, failed: list[str]):
        self.name, self.failed = name, failed
        super().__init__(f"blocking check '{name}' failed: {', '.join(failed)}")
