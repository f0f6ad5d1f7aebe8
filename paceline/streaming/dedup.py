"""Streaming removal of events landed twice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paceline.operators.staging import dedup_events
from paceline.sources.scratch import written
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec
from paceline.streaming.keyed import BUCKETS, MAX_PARTS, KeyedTable

#: Bits per id and probes of the Bloom filters: about one id in a hundred is looked up in vain.
BLOOM_BITS, BLOOM_PROBES = 10, 7


def dedup_stream(stg: DataFrame, *, horizon: str = "7 days", salts: int = 1,
                 spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """One row per event id among copies that land within ``horizon`` of each other.

    The watermark follows *arrival* time, so an event that happened long ago is never
    late, and state is kept only as long as a repeated load is expected: copies landing
    further apart both stay, unlike in ``dedup_events``. Every id is held in one state
    store, a row a copy, never gathered. Where single events land countless times, ``salts``
    above 1 cuts copies per (id, salt) first, over that many tasks and at the price of a
    second store. Rows without an id are all kept.
    """
    arrived = stg.withColumn("arrived_at", F.col("ingested_at").cast("timestamp"))
    known = arrived.where(F.col(spec.event_id).isNotNull()).withWatermark("arrived_at", horizon)
    if salts > 1:
        known = (
            known.withColumn("salt", (F.rand() * salts).cast("int"))
            .dropDuplicatesWithinWatermark([spec.event_id, "salt"]).drop("salt")
        )
    known = known.dropDuplicatesWithinWatermark([spec.event_id])
    unknown = arrived.where(F.col(spec.event_id).isNull())
    return known.drop("arrived_at").unionByName(unknown.drop("arrived_at"))


# -- without a horizon -----------------------------------------------------------------


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits for 64-bit hashes (ids x probes), by double hashing."""
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(BLOOM_PROBES, dtype=np.uint64)) % np.uint64(bits)


def bloom(h: np.ndarray) -> bytes:
    """A Bloom filter of 64-bit hashes."""
    size = max(8, -(-len(h) * BLOOM_BITS // 8))
    flags = np.zeros(size * 8, dtype=bool)
    flags[_places(h, size * 8).ravel()] = True
    return np.packbits(flags).tobytes()


def may_hold(filter_: bytes, h: np.ndarray) -> np.ndarray:
    """False only for hashes that the filter was not built from."""
    at = _places(h, len(filter_) * 8)
    held = np.frombuffer(filter_, dtype=np.uint8)
    return ((held[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)


class SeenIds:
    """Every id that has passed, on disk by hash bucket, with a Bloom filter for each part of a bucket.

    Batches probe the filters first; only ids that may have been seen are looked up, and only
    in the buckets that may hold them. ``buckets`` is to be chosen so that a bucket's ids
    (8 bytes each) fit a task: 64 for some hundred million ids, thousands beyond.
    """

    def __init__(self, spark: SparkSession, path: str, id: str, *, buckets: int = BUCKETS, max_parts: int = MAX_PARTS):
        first = lambda df: df.groupBy(id).agg(F.min("first_batch").alias("first_batch"))
        self.spark, self.path, self.id = spark, path, id
        self.table = KeyedTable(spark, path, [id], first, buckets=buckets, max_parts=max_parts)

    def _filters(self, state) -> DataFrame | None:
        names = sorted({p for parts in state.parts.values() for p in parts})
        if not names:
            return None
        current = self.spark.createDataFrame([(b, p) for b, parts in state.parts.items() for p in parts], "bucket int, part string")
        rows = self.spark.read.option("basePath", f"{self.path}/blooms").parquet(*[f"{self.path}/blooms/part={n}" for n in names])
        return rows.join(F.broadcast(current), ["bucket", "part"], "left_semi")  # at most buckets x max_parts rows

    def unseen(self, rows: DataFrame, before: int) -> DataFrame:
        """The rows whose id no batch before ``before`` has brought; rows differ in their ids."""
        state = self.table.state(before)
        filters = self._filters(state)
        if filters is None:
            return rows
        ids = rows.select(self.id, self.table.bucket().alias("bucket"), F.xxhash64(F.lit("bloom"), self.id).alias("h"))

        def probe(ours: pa.Table, theirs: pa.Table) -> pa.Table:
            h = ours.column("h").to_numpy().view(np.uint64)
            hit = np.zeros(len(h), dtype=bool)
            for bits in theirs.column("bits").to_pylist():
                hit |= may_hold(bits, h)
            return ours.select([0, 1]).filter(pa.array(hit))

        maybe = ids.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, ids.select(self.id, "bucket").schema)
        maybe = written(maybe, "maybe-seen")
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]
        known = self.table.rows(state, buckets)
        if known is None:
            return rows
        seen = maybe.join(known.select(self.id), self.id, "left_semi").select(F.col(self.id).alias("seen_id"))
        return rows.join(seen, F.col(self.id) == F.col("seen_id"), "left_anti")

    def add(self, batch: int, ids: DataFrame) -> None:
        """Records the ids of a batch (column ``id``); a batch that is run again adds nothing."""
        self.table.apply(batch, ids.select(self.id, F.lit(batch).cast("long").alias("first_batch")), self._write_filters)

    def _write_filters(self, part: str) -> None:
        path = f"{self.path}/data/part={part}"
        h = F.xxhash64(F.lit("bloom"), self.id).alias("h")
        kept = self.spark.read.parquet(path).select("bucket", h)

        def built(rows: pa.Table) -> pa.Table:
            bits = bloom(rows.column("h").to_numpy().view(np.uint64))
            return pa.table({"bucket": rows.column("bucket").slice(0, 1), "bits": pa.array([bits], pa.binary())})

        filters = kept.groupBy("bucket").applyInArrow(built, "bucket int, bits binary")
        filters.write.mode("overwrite").parquet(f"{self.path}/blooms/part={part}")


def dedup_for_good(stg: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 seconds", buckets: int = BUCKETS,
                   max_parts: int = MAX_PARTS, spec: FunnelSpec = DEFAULT_FUNNEL) -> StreamingQuery:
    """Appends events to ``out`` once each, however far apart their copies land.

    The kept copy is that of the earliest batch, within a batch the one ``dedup_events`` keeps.
    Rows without an id are all kept. A batch that is run again overwrites its own rows with the
    same ones: ids count only from the batch after the one that brought them.
    """
    seen = SeenIds(stg.sparkSession, f"{out}/ids", spec.event_id, buckets=buckets, max_parts=max_parts)

    def once(batch: DataFrame, number: int) -> None:
        single = written(dedup_events(batch, spec), "batch")
        named = single.where(F.col(spec.event_id).isNotNull())
        new = seen.unseen(named, number)
        path = f"{out}/rows/batch={number}"
        new.unionByName(single.where(F.col(spec.event_id).isNull())).write.mode("overwrite").parquet(path)
        seen.add(number, stg.sparkSession.read.schema(single.schema).parquet(path).where(F.col(spec.event_id).isNotNull()))

    writer = stg.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def deduplicated(spark: SparkSession, out: str) -> DataFrame:
    """The rows of ``dedup_for_good`` so far."""
    return spark.read.parquet(f"{out}/rows").drop("batch")
