"""Spark operators for building, checking and publishing analytical tables."""

from tablewright.errors import CheckFailed, MissingColumn, MissingTable
from tablewright.operators.chain import Chain
from tablewright.session import build_session

__all__ = ["Chain", "CheckFailed", "MissingColumn", "MissingTable", "build_session"]
