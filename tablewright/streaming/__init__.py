"""The same operators on streams.

Everything in ``functions``, ``operators.columns`` (but for
``drop_null_columns``), ``operators.filters`` and ``operators.chain`` that works
row by row applies to a streaming DataFrame as it is.
"""

from tablewright.streaming.deliveries import (
    BatchProfiles,
    harvest_into,
    merged_profile,
    once_per_key,
    run_profiled,
)
from tablewright.streaming.jobs import (
    apply_steps,
    enrich_stream,
    incremental_harvest,
    run_available,
    write_checked,
)

__all__ = [name for name in dir() if not name.startswith("_")]
