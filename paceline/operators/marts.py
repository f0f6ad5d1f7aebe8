"""The five published tables.

``one_row_per_session=True`` states that a session id occurs once in the input (what the
``unique`` data test guards). Distinct sessions are then plain counts, distinct users come
from grouping by user first, and no row is expanded per distinct column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.functions.rates import loss_rate, mean_of, rate
from paceline.functions.time import elapsed_days
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec


def _reached(spec: FunnelSpec, event: str) -> Column:
    s = spec.step(event)
    return F.col(s.reached_col) if s.as_flag else F.col(s.reached_col) > 0


def _once(spec: FunnelSpec, event: str) -> Column:
    """Reached exactly once; a repeated view does not count."""
    s = spec.step(event)
    return F.col(s.reached_col) if s.as_flag else F.col(s.reached_col) == 1


def _count_sessions_and_users(sessions: DataFrame, dims: Sequence[str], counts: Mapping[str, Column],
                              spec: FunnelSpec, one_row_per_session: bool) -> DataFrame:
    """Per ``dims``: n_sessions, n_users, duration_sum, duration_n and the named
    conditional counts."""
    if not one_row_per_session:
        return sessions.groupBy(*dims).agg(
            F.count_distinct(spec.session).alias("n_sessions"),
            F.count_distinct(spec.user).alias("n_users"),
            F.sum("session_duration").alias("duration_sum"),
            F.count("session_duration").alias("duration_n"),
            *[F.count_if(cond).alias(name) for name, cond in counts.items()],
        )
    per_user = sessions.groupBy(*dims, spec.user).agg(
        F.count(spec.session).alias("n_sessions"),
        F.sum("session_duration").alias("duration_sum"),
        F.count("session_duration").alias("duration_n"),
        *[F.count_if(cond).alias(name) for name, cond in counts.items()],
    )
    totals = ["n_sessions", "duration_sum", "duration_n", *counts]
    return per_user.groupBy(*dims).agg(
        F.count(spec.user).alias("n_users"), *[F.sum(c).alias(c) for c in totals],
    )


def conversion_funnel(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL,
                      dims: Sequence[str] | None = None, *,
                      one_row_per_session: bool = False) -> DataFrame:
    """Sessions reaching each step per segment, with pass and loss rates in percent."""
    dims = list(dims or spec.segment)
    counts = {s.funnel_col: _reached(spec, s.event) for s in spec.steps}
    base = _count_sessions_and_users(sessions, dims, counts, spec, one_row_per_session)

    def at(event: str | None) -> Column:
        return F.col("n_sessions") if event is None else F.col(spec.step(event).funnel_col)

    return base.select(
        *dims,
        F.col("n_sessions").alias("total_sessions"),
        F.col("n_users").alias("unique_users"),
        mean_of(F.col("duration_sum"), F.col("duration_n")).alias("avg_session_duration"),
        *counts,
        *[
            (loss_rate if r.complement else rate)(at(r.numerator), at(r.denominator)).alias(r.name)
            for r in spec.rates
        ],
    )


def ab_test_summary(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *,
                    one_row_per_session: bool = False) -> DataFrame:
    """One row per variant. Rates are fractions here, percentages in the funnel."""
    counts = {s.summary_col: _once(spec, s.event) for s in spec.steps if s.summary_col}
    base = _count_sessions_and_users(sessions, [spec.variant], counts, spec, one_row_per_session)
    bought, checkout = spec.steps[-1].summary_col, spec.steps[-2].summary_col
    return base.select(
        spec.variant,
        F.col("n_sessions").alias("total_sessions"),
        F.col("n_users").alias("total_users"),
        *counts,
        rate(F.col(bought), F.col("n_sessions"), 1.0, 4).alias("overall_conversion_rate"),
        rate(F.col(bought), F.col(checkout), 1.0, 4).alias("checkout_to_purchase_rate"),
        mean_of(F.col("duration_sum"), F.col("duration_n")).alias("avg_session_duration_seconds"),
    )


def session_exits(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL,
                  attributes: Sequence[str] | None = None) -> DataFrame:
    """The last event of each session (ties by event id) and the session's event count.

    An aggregate, not a window: partial results are combined map-side, so a session of
    any length is never gathered in one task.
    """
    kept = [spec.device, spec.variant, spec.channel] if attributes is None else list(attributes)
    last = F.max_by(F.struct(*kept, F.col(spec.event_type).alias("exit_event")),
                    F.struct(spec.event_ts, spec.event_id))
    return (
        stg.groupBy(spec.session)
        .agg(last.alias("last"), F.count(F.lit(1)).alias("session_events"))
        .select(spec.session, "last.*", "session_events")
    )


def session_dropoff(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL,
                    dims: Sequence[str] | None = None,
                    share_within: Sequence[str] | None = None) -> DataFrame:
    """Where sessions end. ``exit_percentage`` is a share of all exits in
    ``share_within``, which is coarser than ``dims``."""
    dims = list(dims or [spec.device, spec.variant, spec.channel])
    share_within = list(share_within or [spec.device, spec.variant])
    return exit_shares(session_exits(stg, spec, dims), spec, dims, share_within)


def exit_shares(exits: DataFrame, spec: FunnelSpec, dims: Sequence[str],
                share_within: Sequence[str]) -> DataFrame:
    """Drop-off from ``session_exits`` rows."""
    ends = exits.groupBy(*dims, "exit_event").agg(
        F.count(spec.session).alias("total_exits"),
        F.count_if(F.col("session_events") == 1).alias("bounced_sessions"),
    )
    all_exits = F.sum("total_exits").over(Window.partitionBy(*share_within))
    return ends.withColumn("exit_percentage", rate(F.col("total_exits"), all_exits))


# The day windows after sign-up that the retention table reports.
RETENTION_COUNTS = {
    "newest_users": (0, 0),
    "first_week_users": (6, 8),
    "second_week_users": (13, 15),
    "month_users": (28, 30),
}
RETENTION_RATES = {
    "d1_retention_rate": (1, 1),
    "d7_retention_rate": (6, 8),
    "d14_retention_rate": (13, 15),
}


def user_retention(activity: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL,
                   dims: Sequence[str] | None = None, *, signup: str = "user_signup_date",
                   active_at: str = "session_start",
                   counts: Mapping[str, tuple[int, int]] = RETENTION_COUNTS,
                   rates: Mapping[str, tuple[int, int]] = RETENTION_RATES,
                   mature_only: bool = False) -> DataFrame:
    """Cohorts by sign-up date and ``dims``: size and users active in each day window.

    Each user is reduced to one row of window flags per cohort and the flags are summed,
    so there is no join of cohorts with activity and no distinct count. A cohort with a
    NULL key keeps its size and has zero active users, as an equality join would give.
    ``mature_only`` blanks a rate while its window is still open at the last active day.
    """
    dims = list(dims or [spec.variant, spec.channel])
    days = activity.groupBy(spec.user, *dims, F.col(active_at).cast("date").alias("active_on")).agg(
        F.max(F.col(signup).cast("date")).alias("cohort_date"),
    )
    windows = sorted({*counts.values(), *rates.values()})
    flag = {w: f"days_{w[0]}_{w[1]}" for w in windows}
    age = elapsed_days(F.col("cohort_date"), F.col("active_on"))
    users = days.groupBy("cohort_date", *dims, spec.user).agg(
        *[F.max(F.when(age.between(*w), 1).otherwise(0)).alias(flag[w]) for w in windows],
    )
    matchable = F.lit(True)
    for key in ["cohort_date", *dims]:
        matchable = matchable & F.col(key).isNotNull()
    named_user = F.col(spec.user).isNotNull()
    cohorts = users.groupBy("cohort_date", *dims).agg(
        F.count(spec.user).alias("cohort_size"),
        *[
            F.count_if(matchable & named_user & (F.col(flag[w]) == 1)).alias(flag[w])
            for w in windows
        ],
    )

    def shown(name: str, w: tuple[int, int]) -> Column:
        value = rate(F.col(flag[w]), F.col("cohort_size"))
        if mature_only:
            last_day = days.agg(F.max("active_on")).scalar()
            value = F.when(F.date_add("cohort_date", w[1]) <= last_day, value)
        return value.alias(name)

    return cohorts.select(
        "cohort_date", *dims, "cohort_size",
        *[F.col(flag[w]).alias(name) for name, w in counts.items()],
        *[shown(name, w) for name, w in rates.items()],
    )


def ab_transitions(transitions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *,
                   one_row_per_session: bool = False) -> DataFrame:
    """Mean step gaps per segment and per variant, told apart by ``grain``.

    With one row per session, segments are summed first and only those few rows are
    expanded by the grouping sets; otherwise the sets run over the transitions.
    """
    fine = [spec.variant, spec.device, spec.channel, "user_type"]
    gaps = [gap for _, _, gap in spec.hops]
    if one_row_per_session:
        rows = transitions.groupBy(*fine).agg(
            F.count(spec.session).alias("n"),
            *[F.sum(g).alias(f"{g}_sum") for g in gaps],
            *[F.count(g).alias(f"{g}_n") for g in gaps],
        )
        n_sessions = F.sum("n")
        total = {g: (F.sum(f"{g}_sum"), F.sum(f"{g}_n")) for g in gaps}
    else:
        rows = transitions
        n_sessions = F.count_distinct(spec.session)
        total = {g: (F.sum(g), F.count(g)) for g in gaps}
    sets = rows.groupingSets([[F.col(c) for c in fine], [F.col(spec.variant)]], *fine)
    return sets.agg(
        F.when(F.grouping(spec.device) == 1, "variant_level").otherwise("segment_level").alias("grain"),
        n_sessions.alias("total_sessions"),
        *[mean_of(*total[g]).alias(f"avg_{g}") for g in gaps],
    )
