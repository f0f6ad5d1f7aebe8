"""Events to sessions and step-to-step times.

Every session aggregate is mergeable (min, max, sum of counts), so the same two functions
serve the batch tables and the streaming ones: ``session_partials`` folds events,
``merge_partials`` folds partials, ``finish_sessions`` derives the published columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.time import boundary_seconds
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec


def _step_counts(spec: FunnelSpec) -> list[Column]:
    return [
        F.count_if(F.col(spec.event_type) == s.event).alias(s.reached_col) for s in spec.steps
    ]


def _first_seen(spec: FunnelSpec) -> list[Column]:
    return [
        F.min(F.when(F.col(spec.event_type) == s.event, F.col(spec.event_ts))).alias(s.first_ts_col)
        for s in spec.steps
    ]


def session_partials(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *,
                     step_times: bool = False) -> DataFrame:
    """Mergeable aggregates per (session, user, variant, device).

    With ``step_times`` the first time of every step rides along, which saves a second
    pass when sessions and step transitions are both wanted.
    """
    return stg.groupBy(*spec.session_key).agg(
        F.max(spec.channel).alias(spec.channel),
        F.max(spec.signup).alias("user_signup_date"),
        F.min(spec.event_ts).alias("session_start"),
        F.max(spec.event_ts).alias("session_end"),
        F.count(spec.event_id).alias("total_events"),
        *_step_counts(spec),
        *(_first_seen(spec) if step_times else []),
    )


def merge_partials(partials: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Fold partials of the same session that were built from different events."""
    sums = ["total_events", *[s.reached_col for s in spec.steps]]
    step_times = [s.first_ts_col for s in spec.steps if s.first_ts_col in partials.columns]
    return partials.groupBy(*spec.session_key).agg(
        F.max(spec.channel).alias(spec.channel),
        F.max("user_signup_date").alias("user_signup_date"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in sums],
        *[F.min(c).alias(c) for c in step_times],
    )


def finish_sessions(partials: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Published session columns from one row of aggregates per session."""
    started_on_signup = F.col("user_signup_date") == F.col("session_start").cast("date")
    step_times = [s.first_ts_col for s in spec.steps if s.first_ts_col in partials.columns]
    return partials.select(
        spec.session, spec.user, spec.device, spec.variant, spec.channel, "user_signup_date",
        F.when(started_on_signup, "new_user").otherwise("returning_user").alias("user_type"),
        "session_start", "session_end",
        boundary_seconds(F.col("session_start"), F.col("session_end")).alias("session_duration"),
        "total_events",
        *[
            (F.col(s.reached_col) > 0).alias(s.reached_col) if s.as_flag else F.col(s.reached_col)
            for s in spec.steps
        ],
        *step_times,
    )


def int_sessions(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """One row per (session, user, variant, device)."""
    return finish_sessions(session_partials(stg, spec), spec)


def session_facts(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Sessions and their first step times from a single aggregate.

    Same rows as sessions joined with transitions, provided a session id belongs to one
    user, variant and device (the ``unique`` data test on sessions).
    """
    return finish_sessions(session_partials(stg, spec, step_times=True), spec)


def transition_columns(spec: FunnelSpec = DEFAULT_FUNNEL) -> list[Column]:
    return [
        F.col(spec.session), F.col(spec.user), F.col(spec.device), F.col(spec.variant),
        F.col(spec.channel), F.col("user_type"), F.col("session_end"),
        *[F.col(s.first_ts_col) for s in spec.steps],
        *[
            boundary_seconds(F.col(a.first_ts_col), F.col(b.first_ts_col)).alias(gap)
            for a, b, gap in spec.hops
        ],
    ]


def int_step_transition(stg: DataFrame, sessions: DataFrame,
                        spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """First time of each step per session id, joined to the session's attributes.

    Safe for any input: a session id shared by several users gives one row per session
    row, all with the same step times. A gap is negative when steps are out of order.
    """
    steps = stg.groupBy(spec.session).agg(*_first_seen(spec))
    return steps.join(sessions, spec.session).select(*transition_columns(spec))


def transitions_from_facts(facts: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Step transitions from ``session_facts``; rows without a session id drop out, as
    they would in the join."""
    return facts.where(F.col(spec.session).isNotNull()).select(*transition_columns(spec))


def first_session_per_user(sessions: DataFrame, attributes: list[str],
                           spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Each user's attributes as of the earliest session (ties by session id)."""
    first = F.min_by(F.struct(*attributes), F.struct("session_start", spec.session))
    return sessions.groupBy(spec.user).agg(first.alias("first")).select(spec.user, "first.*")
