"""Reading delivered files."""

from tillroll.sources.files import (
    UnknownHeader,
    conform,
    discover,
    empty,
    has_rows,
    headers,
    read_csv,
    read_inputs,
    route,
    split_lines,
)

__all__ = [
    "UnknownHeader",
    "conform",
    "discover",
    "empty",
    "has_rows",
    "headers",
    "read_csv",
    "read_inputs",
    "route",
    "split_lines",
]
