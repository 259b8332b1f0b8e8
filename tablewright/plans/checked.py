"""Sales that pass a contract before they are published."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablewright.operators.columns import move_renamed_last
from tablewright.operators.filters import HIGH_VALUE_MINIMUM
from tablewright.plans.sales import sales_output
from tablewright.quality.checks import require
from tablewright.quality.contracts import Contract, run_contract
from tablewright.sources.sinks import WriteResult, write_json

# The checks of the enriched sales.
SALES_CONTRACT = Contract.from_dict(
    {
        "dataset": "sales_transform",
        "columns": [
            {
                "name": "sale_price_usd",
                "checks": [
                    {"missing": {"must_be": 0}},
                    {"invalid": {"must_be": 0, "valid_min": 1}},
                ],
            },
            {"name": "artist_name", "checks": [{"missing": {"must_be": 0}}]},
            {
                "name": "list_price_usd",
                "checks": [
                    {"missing": {"must_be": 0}},
                    {"invalid": {"must_be": 0, "valid_min": 1}},
                ],
            },
        ],
        "checks": [
            {"row_count": {"must_be_greater_than": 0}},
            {"duplicate": {"columns": ["sale_id"], "must_be": 0}},
        ],
    }
)


def checked_sales_output(
    transformed: DataFrame,
    path: str,
    contract: Contract = SALES_CONTRACT,
    minimum=HIGH_VALUE_MINIMUM,
) -> WriteResult:
    """Check the sales, then write the high-value ones with ``price_difference`` last.

    A failed check raises ``CheckFailed`` and nothing is written. Pass a staged
    or stored table: the check and the write each read it once.
    """
    require(run_contract(transformed, contract), contract.dataset)
    published = move_renamed_last(
        sales_output(transformed, minimum), {"price_diff": "price_difference"}
    )
    return write_json(published, path)
