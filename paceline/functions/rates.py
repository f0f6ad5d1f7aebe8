"""Rounded averages and ratios with a zero-denominator guard.

All arithmetic is DOUBLE: Spark would average DECIMAL literals to too few digits.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _guarded(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def rate(num: Column, den: Column, scale: float = 100.0, digits: int = 2) -> Column:
    """``scale * num / den`` rounded, NULL when ``den`` is zero."""
    return F.round(F.lit(scale) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def loss_rate(num: Column, den: Column, scale: float = 100.0, digits: int = 2) -> Column:
    """``scale * (1 - num / den)`` rounded, NULL when ``den`` is zero."""
    return F.round(F.lit(scale) * (F.lit(1.0) - _guarded(num, den)), digits)


def mean_of(total: Column, n: Column, digits: int = 2) -> Column:
    """Rounded mean from a pre-aggregated total and count."""
    return F.round(_guarded(total, n), digits)
