"""Column-level helpers (built-in Spark expressions only)."""

from strata.functions.columns import lenient_date, list_to_text, required, year_prefix
from strata.functions.fields import (
    Reading,
    element_fault,
    page_fault,
    read_field,
    read_list,
    read_number,
    read_text,
)

__all__ = [
    "Reading",
    "element_fault",
    "lenient_date",
    "list_to_text",
    "page_fault",
    "read_field",
    "read_list",
    "read_number",
    "read_text",
    "required",
    "year_prefix",
]
