"""Funnel events from the plain ``events`` table (user, time, type only).

Sessions come from inactivity gaps, the funnel step from the event's own type (views split by
the parity of the event id), and the arm, device and channel are functions of the user.
Every event is kept: steps may repeat, come out of order or be missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from paceline.operators.sessionize import sessionize
from paceline.spec import DEFAULT_DOMAINS, DEFAULT_FUNNEL, FunnelSpec

GAP_HOURS = 8


# Place of an event in the funnel, from 0, by its type.
STEP_OF_EVENT = ("CASE event_type WHEN 'view' THEN event_id % 2 * 2 WHEN 'signup' THEN 1 WHEN 'click' THEN 3 "
                 "WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 END")
# Arm, device and channel as functions of the numeric user id. Arms are unequal, one user in
# twenty has no device, and for another one in twenty the channel differs between events.
ARM_OF_USER = "CASE WHEN (user_id * 7919 + 13) % 97 % 5 < 3 THEN 0 ELSE 1 END"
DEVICE_OF_USER = "CASE WHEN user_id % 20 <> 7 THEN (user_id * 104729 + 7) % 101 % 3 END"
CHANNEL_OF_USER = "((user_id * 1299709 + 3) % 103 + IF(user_id % 20 = 3, event_id % 2, 0)) % 4"


def _pick(values: tuple[str, ...], index: str) -> str:
    """The value at ``index``, NULL for a NULL index (``element_at`` would give some value)."""
    return f"CASE int({index}) " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def funnel_events(events: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Staged-event layout over ``events(event_id, ts, user_id, event_type)``."""
    columns = events.select("event_id", "ts", "user_id", "event_type")
    placed = sessionize(columns, "user_id", "ts", GAP_HOURS, with_first=True)
    d = DEFAULT_DOMAINS
    return placed.selectExpr(
        f"string(event_id) AS {spec.event_id}",
        f"'usr_' || user_id AS {spec.user}",
        f"'usr_' || user_id || '_s' || session_no AS {spec.session}",
        f"{_pick(tuple(s.event for s in spec.steps), STEP_OF_EVENT)} AS {spec.event_type}",
        f"ts AS {spec.event_ts}",
        f"{_pick(d.variant, ARM_OF_USER)} AS {spec.variant}",
        f"{_pick(d.acquisition_channel, CHANNEL_OF_USER)} AS {spec.channel}",
        f"date(user_first_ts) AS {spec.signup}",
        f"{_pick(d.device, DEVICE_OF_USER)} AS {spec.device}",
        "localtimestamp() AS ingested_at",
    )
