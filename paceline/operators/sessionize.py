"""Session numbers from inactivity gaps, without sorting any user's whole history.

Time is cut into slices exactly as wide as the allowed gap. Two events in one slice are
closer than the gap, so a session can only break *between* slices: the breaks follow from
each slice's first and last event. Slices are formed by an aggregate with map-side
combine, so a user holding a third of all events still reduces to (time range / gap) rows
before anything is ordered per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.functions.time import epoch_micros

MICROS_PER_HOUR = 3_600_000_000


def slice_start(ts: Column, gap_micros: int) -> Column:
    at = epoch_micros(ts)
    return at - F.pmod(at, F.lit(gap_micros))


def session_slices(events: DataFrame, user: str, ts: str, gap_hours: int) -> DataFrame:
    """One row per (user, slice): session number, events of the session before the slice,
    and the user's first event time."""
    gap = gap_hours * MICROS_PER_HOUR
    placed = events.dropna(subset=[user, ts])
    slices = placed.groupBy(user, slice_start(F.col(ts), gap).alias("slice")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"),
    )
    by_user = Window.partitionBy(user).orderBy("slice")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_user.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lag("last_ts").over(by_user)
    marked = slices.select(
        user, "slice", "first_ts",
        (previous.isNull() | (epoch_micros(F.col("first_ts")) - epoch_micros(previous) > gap)).alias("opens"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    return marked.select(
        user, "slice",
        F.sum(F.col("opens").cast("long")).over(so_far).alias("session_no"),
        (F.col("before") - F.max(F.when(F.col("opens"), F.col("before"))).over(so_far)).alias("events_before"),
        F.min("first_ts").over(so_far).alias("user_first_ts"),
    )


def sessionize(events: DataFrame, user: str, ts: str, gap_hours: int, with_first: bool = False) -> DataFrame:
    """``events`` plus ``session_no``: a new session after more than ``gap_hours`` idle.

    ``with_first`` adds ``user_first_ts``, the time of the user's first event.

    Every event is kept; one without a user or a time belongs to no session (NULL). The
    join is left to adaptive execution: it broadcasts the slices if they turn out
    small and splits a slice that holds much of the data if they do not.
    """
    columns = [user, "slice", "session_no", *["user_first_ts"] * with_first]
    slices = session_slices(events, user, ts, gap_hours).select(*columns)
    gap = gap_hours * MICROS_PER_HOUR
    return (
        events.withColumn("slice", slice_start(F.col(ts), gap))
        .join(slices, [user, "slice"], "left")
        .drop("slice")
    )


def session_openers(events: DataFrame, user: str, ts: str, order_id: str, gap_hours: int,
                    first: int) -> DataFrame:
    """The first ``first`` events of every session, with ``session_no``, ``pos`` and
    ``user_first_ts``. Events without a user or a time open no session.

    A session's opening events are among the opening events of its slices, so each slice
    is cut to ``first`` rows before the shuffle (a row_number limit runs map-side) and
    placed by the count of events its session had before.
    """
    gap = gap_hours * MICROS_PER_HOUR
    slices = session_slices(events, user, ts, gap_hours).where(F.col("events_before") < first)
    in_slice = Window.partitionBy(user, "slice").orderBy(ts, order_id)
    heads = (
        events.select("*", slice_start(F.col(ts), gap).alias("slice"))
        .select("*", F.row_number().over(in_slice).alias("rank_in_slice"))
        .where(f"rank_in_slice <= {first}")
    )
    return (
        heads.join(slices, [user, "slice"])
        .selectExpr(*events.columns, "session_no", "user_first_ts", "events_before + rank_in_slice AS pos")
        .where(f"pos <= {first}")
    )
