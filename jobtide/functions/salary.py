"""Salary band arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(c: Column) -> Column:
    """Mean through a decimal sum: the same in any row order and partitioning."""
    amount = c.cast("decimal(18,4)")
    return F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))


def band_columns(low: Column, high: Column) -> dict[str, Column]:
    """Padded bounds, widths of the three bar segments, and the ``$xK-$yK`` label."""
    pad = (high - low) / 2
    lower, upper = low - pad, high + pad
    thousands = lambda c: (c / 1000).cast("long").cast("string")
    return {
        "LOWER_BOUND": lower,
        "UPPER_BOUND": upper,
        "LEAD_WIDTH": low - lower,
        "BAND_WIDTH": high - low,
        "TAIL_WIDTH": upper - high,
        "BAND_TEXT": F.concat(F.lit("$"), thousands(low), F.lit("K-$"), thousands(high), F.lit("K")),
    }
