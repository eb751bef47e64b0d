"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, decimals: int) -> Column:
    """HALF_UP rounding of a double (``1/128`` -> ``0.007813`` at 6 places).
    Spark's ``round`` is HALF_UP on the decimal expansion of the double."""
    return F.round(x, decimals)


def format_fixed(x: Column, decimals: int = 6) -> Column:
    """Fixed-point text with ``decimals`` places, HALF_UP (``%.6f`` style)."""
    return F.format_string(f"%.{decimals}f", x)
