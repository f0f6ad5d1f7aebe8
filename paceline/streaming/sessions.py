"""Session table kept up to date by a stream.

Each micro-batch writes the mergeable aggregates of the sessions it touched into its own
folder; reading folds them. No batch rereads or rewrites earlier data, late events simply
add another partial, and a retried batch overwrites its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paceline.operators.sessions import finish_sessions, merge_partials, session_partials
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec
from paceline.streaming.keyed import BUCKETS, MAX_PARTS, KeyedTable

LOG = "upto long"


def stream_session_partials(stg: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 seconds",
                            spec: FunnelSpec = DEFAULT_FUNNEL) -> StreamingQuery:
    """Partials under ``out/batches``; ``out/log`` records what has been folded together."""
    stg.sparkSession.createDataFrame([(-1,)], LOG).write.mode("ignore").parquet(f"{out}/log")

    def fold(batch: DataFrame, batch_id: int) -> None:
        partials = session_partials(batch, spec, step_times=True)
        partials.write.mode("overwrite").parquet(f"{out}/batches/batch={batch_id}")

    writer = stg.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _folded(spark: SparkSession, path: str) -> int:
    return spark.read.schema(LOG).parquet(f"{path}/log").agg(F.max("upto")).first()[0]


def _partials(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The last folded table and the batches after it, to batch ``upto`` if given."""
    folded = _folded(spark, path)
    batches = spark.read.parquet(f"{path}/batches").where(F.col("batch") > folded)
    if upto is not None:
        batches = batches.where(F.col("batch") <= upto)
    later = batches.drop("batch")
    return later if folded < 0 else spark.read.parquet(f"{path}/folded/upto={folded}").unionByName(later)


def compact_partials(spark: SparkSession, path: str, upto: int, spec: FunnelSpec = DEFAULT_FUNNEL) -> None:
    """Fold everything to batch ``upto``, which must have ended (``lastProgress``), into one table.

    May run beside the stream. The table is written first and one log row switches readers
    to it, so they see either the old partials or the folded ones. Folded batch folders
    can be deleted once no reader started before the switch.
    """
    if upto > _folded(spark, path):
        merged = merge_partials(_partials(spark, path, upto), spec)
        merged.write.mode("overwrite").parquet(f"{path}/folded/upto={upto}")
        spark.createDataFrame([(upto,)], LOG).write.mode("append").parquet(f"{path}/log")


def streamed_sessions(spark: SparkSession, path: str, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Sessions with step times, as ``session_facts`` gives them over the same events."""
    return finish_sessions(merge_partials(_partials(spark, path), spec), spec)


# -- by key ----------------------------------------------------------------------------


def session_table(spark: SparkSession, path: str, *, buckets: int = BUCKETS, max_parts: int = MAX_PARTS,
                  spec: FunnelSpec = DEFAULT_FUNNEL) -> KeyedTable:
    """Mergeable session aggregates by session key: what a reader folds does not grow with batches."""
    return KeyedTable(spark, path, spec.session_key, lambda df: merge_partials(df, spec), buckets=buckets, max_parts=max_parts)


def keep_sessions(stg: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 seconds", buckets: int = BUCKETS,
                  max_parts: int = MAX_PARTS, spec: FunnelSpec = DEFAULT_FUNNEL) -> StreamingQuery:
    """Keeps the session table at ``out`` up to date; late events reach the sessions they belong to."""
    table = session_table(stg.sparkSession, out, buckets=buckets, max_parts=max_parts, spec=spec)

    def fold(batch: DataFrame, number: int) -> None:
        table.apply(number, session_partials(batch, spec, step_times=True))

    writer = stg.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def kept_sessions(spark: SparkSession, path: str, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame | None:
    """Sessions with step times as of the last committed batch; None before the first."""
    partials = session_table(spark, path, spec=spec).read()
    return None if partials is None else finish_sessions(partials, spec)
