"""Column expressions: built-in Spark functions only, so they stay inside code generation."""

from tarnlake.functions.dates import order_date, parse_timestamp
from tarnlake.functions.records import json_text, parse_record
from tarnlake.functions.text import (
    batch_label,
    decimal_comma,
    first_chars,
    null_tokens_to_null,
    trailing_number,
)

__all__ = [
    "batch_label",
    "decimal_comma",
    "first_chars",
    "json_text",
    "null_tokens_to_null",
    "order_date",
    "parse_record",
    "parse_timestamp",
    "trailing_number",
]
