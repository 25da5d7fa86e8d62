"""Number formatting for report and chart labels (JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(x: Column) -> Column:
    """Integer with comma thousands separators: 1234567 -> '1,234,567'."""
    return F.format_number(x, 0)


def fixed1(x: Column) -> Column:
    """One decimal with separators: 1234.5 -> '1,234.5' (half-even)."""
    return F.format_number(x, 1)


def bar_label(w: Column) -> Column:
    """Value label of a bar: '1.23M' from one million up, else '12,345.6'."""
    millions = F.call_function("format_number", w / 1e6, F.lit("0.00"))
    return F.when(w >= 1e6, F.concat(millions, F.lit("M"))).otherwise(fixed1(w))


def tick_label(x: Column) -> Column:
    """Axis tick text: '1.2M' from one million up, else '12,346' (half-even)."""
    millions = F.call_function("format_number", x / 1e6, F.lit("0.0"))
    return F.when(x >= 1e6, F.concat(millions, F.lit("M"))).otherwise(thousands(x))
