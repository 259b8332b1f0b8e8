"""Column lineage and short profiles of tables."""

from tablewright.lineage.edges import (
    column_lineage,
    passthrough_lineage,
    trace_errors,
    trace_to_roots,
    whole_lineage,
)
from tablewright.lineage.profile import (
    formatted_example,
    output_statistics,
    profile,
    raw_examples,
    stored_rows,
)

__all__ = [name for name in dir() if not name.startswith("_")]
