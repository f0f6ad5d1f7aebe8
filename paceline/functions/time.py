"""Time differences on zone-less timestamps (session time zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def boundary_seconds(start: Column, end: Column) -> Column:
    """Second *boundaries* crossed from ``start`` to ``end``.

    Warehouse ``datediff('second', …)`` counts boundaries, Spark's ``timestampdiff``
    counts elapsed whole seconds; 0.9 s → 1.1 s is one boundary but zero elapsed seconds.
    """
    return epoch_seconds(end) - epoch_seconds(start)


def elapsed_micros(start: Column, end: Column) -> Column:
    return epoch_micros(end) - epoch_micros(start)


def elapsed_days(start: Column, end: Column) -> Column:
    """Calendar days from date ``start`` to the date of ``end``."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("long")
