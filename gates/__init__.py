from gates import (  # noqa: F401
    checks,
    columns,
    files,
    lineage,
    plans,
    publishing,
    relational,
    streams,
    values,
)
from gates.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
