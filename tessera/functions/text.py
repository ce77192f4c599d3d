"""String helpers as built-in column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ELLIPSIS = "…"


def trim_ws(c: Column) -> Column:
    """Strip surrounding whitespace of any kind (SQL ``trim`` removes only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]*>", "")


def after_marker(c: Column, marker: str) -> Column:
    """Text after the last ``marker``, stripped; unchanged when the marker is absent."""
    return F.when(F.instr(c, marker) > 0,
                  trim_ws(F.element_at(F.split(c, _quote(marker)), -1))).otherwise(c)


def truncate_ellipsis(c: Column, n: int) -> Column:
    """First ``n`` characters followed by an ellipsis (always appended)."""
    return F.concat(F.substring(c, 1, n), F.lit(ELLIPSIS))


def count_char(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def base_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def fold_lower_ascii(c: Column) -> Column:
    """Lower case with the one accented letter the categories need folded."""
    return F.translate(F.lower(c), "ñ", "n")


def _quote(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch)
    return "".join(out)
