"""Scalar column functions (JVM-side, codegen friendly)."""

from ledgerloom.functions.scalar import (
    active_flag,
    day_key,
    first_present,
    money_text,
    month_day_names,
    parse_date,
    safe_number,
    to_double,
)

__all__ = [
    "active_flag",
    "day_key",
    "first_present",
    "money_text",
    "month_day_names",
    "parse_date",
    "safe_number",
    "to_double",
]
