"""Column-expression helpers (built-in functions only, no Python UDFs)."""

from tessera.functions.keys import compose_key, parse_key, two_decimals
from tessera.functions.text import (
    after_marker, base_name, count_char, fold_lower_ascii, strip_tags, trim_ws, truncate_ellipsis,
)

__all__ = [
    "compose_key", "parse_key", "two_decimals", "after_marker", "base_name", "count_char",
    "fold_lower_ascii", "strip_tags", "trim_ws", "truncate_ellipsis",
]
