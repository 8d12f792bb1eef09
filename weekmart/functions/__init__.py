"""Column -> Column helpers (all JVM-side built-ins, no Python UDFs)."""

from weekmart.functions.dates import (
    date_serial, iso_week, iso_year, parse_period_label, period_label,
    week_exists, week_monday,
)
from weekmart.functions.names import bare_names, safe_name, safe_names
from weekmart.functions.values import (
    coerce_column, finite, number_to_text, text_to_serial,
)
from weekmart.functions.sizes import human_size

__all__ = [
    "date_serial", "iso_week", "iso_year", "parse_period_label", "period_label",
    "week_exists", "week_monday", "bare_names", "safe_name", "safe_names",
    "coerce_column", "finite", "number_to_text", "text_to_serial", "human_size",
]
