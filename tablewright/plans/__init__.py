"""The two enriched tables, their outputs and their variants."""

from tablewright.plans.catalogue import (
    ARTWORKS_SCHEMA,
    artworks_by_tier,
    artworks_output,
    artworks_transform,
    media_parts,
)
from tablewright.plans.checked import checked_sales_output
from tablewright.plans.sales import (
    SALES_SCHEMA,
    sales_by_threshold,
    sales_colocated,
    sales_output,
    sales_transform,
    store_for_sales,
)

__all__ = [
    "ARTWORKS_SCHEMA",
    "SALES_SCHEMA",
    "artworks_by_tier",
    "artworks_output",
    "artworks_transform",
    "checked_sales_output",
    "media_parts",
    "sales_by_threshold",
    "sales_colocated",
    "sales_output",
    "sales_transform",
    "store_for_sales",
]
