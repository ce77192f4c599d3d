"""Composite keys and numeric rendering as column expressions.

The scheduler of the original packs ``product_hour_slot`` into one string; here the
three parts stay typed columns, and these helpers only convert at the boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compose_key(*parts: Column, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[p.cast("string") for p in parts])


def parse_key(key: Column, n: int, sep: str = "_", cast: str = "int") -> list[Column]:
    pieces = F.split(key, sep)
    return [F.element_at(pieces, i + 1).cast(cast) for i in range(n)]


def two_decimals(c: Column) -> Column:
    """Money or score text with two decimals (``format_number`` groups thousands)."""
    return F.format_string("%.2f", c.cast("double"))
