"""Column expressions (``Column -> Column``), all built-in and codegen-friendly."""

from statflow.functions.arrays import every_other, pad_array, positional_columns
from statflow.functions.casts import int_trunc, null_to_zero, to_float
from statflow.functions.dates import parse_iso_date, parse_long_date
from statflow.functions.strings import (
    extract_number,
    json_field,
    last_segment,
    second_line,
    strip_unit,
    tokens,
)

__all__ = [
    "every_other",
    "extract_number",
    "int_trunc",
    "json_field",
    "last_segment",
    "null_to_zero",
    "pad_array",
    "parse_iso_date",
    "parse_long_date",
    "positional_columns",
    "second_line",
    "strip_unit",
    "to_float",
    "tokens",
]
