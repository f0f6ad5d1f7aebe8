"""Landing rows to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paceline.spec import DEFAULT_FUNNEL, FunnelSpec


def _paths(spec: FunnelSpec) -> list[tuple[str, str, str]]:
    """(output column, JSON path, type); the paths are fixed by the producer."""
    return [
        (spec.event_id, "$.event_id", "string"),
        (spec.user, "$.user_id", "string"),
        (spec.session, "$.session_id", "string"),
        (spec.event_type, "$.event_type", "string"),
        (spec.event_ts, "$.timestamp", "timestamp_ntz"),
        (spec.variant, "$.customer_metadata.experiment_variant", "string"),
        (spec.channel, "$.customer_metadata.acquisition_channel", "string"),
        (spec.signup, "$.customer_metadata.signup_date", "date"),
        (spec.device, "$.device", "string"),
    ]


def stg_events(landing: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *, strict: bool = True) -> DataFrame:
    """Typed event columns. A missing path is NULL; a value that does not cast fails the
    job, or is NULL when not ``strict``."""
    get = F.variant_get if strict else F.try_variant_get
    return landing.select(
        *[get("raw_payload", path, kind).alias(name) for name, path, kind in _paths(spec)],
        "ingested_at",
    )


def dedup_events(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """One row per event id, for a landing table loaded twice.

    Rows without an id are all kept: each gets a number of its own beside the empty id, so
    they neither collapse nor meet in one task. The kept copy is the earliest load, ties
    by the other columns, so differing copies of one load always give the same row. One
    scan; copies are cut map-side, before the shuffle.
    """
    nameless = F.when(F.col(spec.event_id).isNull(), F.monotonically_increasing_id())
    others = [c for c in stg.columns if c not in (spec.event_id, "ingested_at")]
    first = Window.partitionBy(spec.event_id, "nameless").orderBy("ingested_at", *others)
    return (
        stg.withColumn("nameless", nameless)
        .withColumn("copy_no", F.row_number().over(first))
        .where("copy_no = 1").drop("copy_no", "nameless")
    )
