"""Retention cohorts kept up to date by a stream.

Two keyed tables: sessions, and the days a user was active in a cohort with the number of
sessions that say so. A batch takes the sessions it touches as they were and as they become,
and adds the difference to the day counts. So a late event that moves the start of a session to
an earlier day, or a sign-up date that changes with it, takes the old day back; a day counts
while any session is left on it. Cohorts are read from the days, not from events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paceline.operators.marts import user_retention
from paceline.operators.sessions import finish_sessions, merge_partials, session_partials
from paceline.sources.scratch import written
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec
from paceline.streaming.keyed import BUCKETS, MAX_PARTS, KeyedTable
from paceline.streaming.sessions import session_table


class RetentionTable:
    """Session aggregates and active days under one folder."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = BUCKETS, max_parts: int = MAX_PARTS,
                 spec: FunnelSpec = DEFAULT_FUNNEL):
        self.spec = spec
        self.day = [spec.user, spec.variant, spec.channel, "user_signup_date", "active_on"]
        self.sessions = session_table(spark, f"{path}/sessions", buckets=buckets, max_parts=max_parts, spec=spec)
        counted = lambda df: df.groupBy(*self.day).agg(F.sum("sessions").alias("sessions"))
        self.days = KeyedTable(spark, f"{path}/days", self.day, counted, buckets=buckets, max_parts=max_parts)

    def _active(self, partials: DataFrame, weight: int) -> DataFrame:
        days = finish_sessions(partials, self.spec).withColumn("active_on", F.col("session_start").cast("date"))
        return days.select(*self.day, F.lit(weight).cast("long").alias("sessions"))

    def changes(self, batch: int, partials: DataFrame) -> DataFrame:
        """Day counts that ``partials`` add and take away, from the state before the batch."""
        state = self.sessions.state(before=batch)
        buckets = [r["b"] for r in partials.select(self.sessions.bucket().alias("b")).distinct().collect()]
        known = self.sessions.rows(state, buckets)
        if known is None:
            return self._active(partials, 1)
        same = F.lit(True)
        touched = partials.select(*[F.col(k).alias(f"touched_{k}") for k in self.spec.session_key])
        for k in self.spec.session_key:
            same = same & F.col(k).eqNullSafe(F.col(f"touched_{k}"))
        old = written(merge_partials(known.drop("bucket").join(touched, same, "left_semi"), self.spec), "sessions-before")
        new = merge_partials(old.unionByName(partials), self.spec)
        both = self._active(new, 1).unionByName(self._active(old, -1))
        return both.groupBy(*self.day).agg(F.sum("sessions").alias("sessions")).where("sessions <> 0")

    def apply(self, batch: int, events: DataFrame) -> None:
        """Adds the events of a batch, once; either table may already have them from a run that was killed."""
        partials = written(session_partials(events, self.spec), "partials")
        self.days.apply(batch, self.changes(batch, partials))
        self.sessions.apply(batch, partials)

    def read(self) -> DataFrame | None:
        """Cohorts as ``user_retention`` gives them over the same events; None before the first batch."""
        days = self.days.read()
        return None if days is None else user_retention(days.where("sessions > 0"), self.spec, active_at="active_on")


def stream_retention(stg: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 seconds", buckets: int = BUCKETS,
                     max_parts: int = MAX_PARTS, spec: FunnelSpec = DEFAULT_FUNNEL) -> StreamingQuery:
    """Keeps the cohorts below ``out`` up to date."""
    table = RetentionTable(stg.sparkSession, out, buckets=buckets, max_parts=max_parts, spec=spec)
    writer = stg.writeStream.foreachBatch(lambda batch, number: table.apply(number, batch))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
