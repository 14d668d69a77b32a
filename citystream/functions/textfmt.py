"""Fixed-width report formatting (F12). Pads only: long values are never cut."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _left(c: Column, width: int) -> Column:
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, " "))


def _right(c: Column, width: int) -> Column:
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, " "))


def fixed_width_line(label: Column, count: Column, label_width: int,
                     pct: Column | None = None) -> Column:
    """``"   {label:<w} {count:>6}"`` plus ``"  ({pct:5.1f}%)"`` when given."""
    parts = [F.lit("   "), _left(label, label_width), F.lit(" "),
             _right(count.cast("string"), 6)]
    if pct is not None:
        parts += [F.lit("  ("), _right(F.format_string("%.1f", pct), 5), F.lit("%)")]
    return F.concat(*parts)
