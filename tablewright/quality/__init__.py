"""Typed schemas, contracts and single checks."""

from tablewright.quality.checks import (
    allowed_values,
    failure_rate,
    foreign_keys,
    minimum_rows,
    reference_check,
    require,
    require_columns,
    schema_contract,
    threshold_check,
    value_range,
    warnings_report,
    write_when_passed,
)
from tablewright.quality.contracts import Contract, checks_from_lists, run_contract
from tablewright.quality.increments import (
    ContractStates,
    contract_state,
    judge_state,
    merge_states,
)
from tablewright.quality.schema import (
    Field,
    TableSchema,
    check_rows,
    error_table,
    remove_invalid,
    schema_errors,
    validate,
    validation_report,
)

__all__ = [name for name in dir() if not name.startswith("_")]
