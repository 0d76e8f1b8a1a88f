"""Column expressions shared by the jobs. All are built-in Spark expressions."""

from paytally.functions.columns import (
    calendar_date,
    display_name,
    integer_id,
    on_day,
    to_units,
    valid,
)

__all__ = ["calendar_date", "display_name", "integer_id", "on_day", "to_units", "valid"]
