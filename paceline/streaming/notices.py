"""Landing by notification: files are loaded because a message names them, not because a folder was listed.

The log is a folder of small JSON files in the layout in which object stores announce new objects. A
stream reads it with its own offsets, so a restart goes on where the last run stopped, and can move
messages it has dealt with to another folder, so the log itself stays short. What a message names is
landed once, however often and however late it is named again: names are kept on disk by hash
bucket (``streaming.dedup.SeenIds``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paceline.sources.json_values import read_values
from paceline.sources.landing import landing_row
from paceline.sources.scratch import written
from paceline.streaming.dedup import SeenIds
from paceline.streaming.keyed import BUCKETS, MAX_PARTS

#: The layout of a message, and how the name of an event that brings an object begins.
MESSAGE = ("Records array<struct<eventName: string, s3: struct<bucket: struct<name: string>, "
           "object: struct<key: string, size: bigint>>>>")
CREATED = "ObjectCreated"
JSON_KEYS = r"\.json(\.gz)?$"


def _root(bucket: Column, roots: Mapping[str, str] | None) -> Column:
    """Where a bucket's objects lie: its entry in ``roots``, else the bucket of that name."""
    place = F.concat(F.lit("s3a://"), bucket)
    for name, path in (roots or {}).items():
        place = F.when(bucket == name, F.lit(path.rstrip("/"))).otherwise(place)
    return place


def named_files(messages: DataFrame, roots: Mapping[str, str] | None = None, keys: str = JSON_KEYS) -> DataFrame:
    """``source_file, length``: a row for each new object that a message in ``value`` names.

    Keys come percent-encoded. Messages of other events, of keys that do not match ``keys`` and
    texts that are no message give no rows; an unknown size counts as 0 and the file as one range.
    """
    record = F.explode(F.from_json(F.col("value").cast("string"), MESSAGE)["Records"]).alias("record")
    found = messages.select(record).select(
        F.col("record.eventName").alias("event"), F.col("record.s3.bucket.name").alias("bucket"),
        F.url_decode("record.s3.object.key").alias("key"), F.col("record.s3.object.size").alias("size"))
    found = found.where(F.col("event").contains(CREATED) & F.col("bucket").isNotNull() & F.col("key").rlike(keys))
    return found.select(F.concat(_root(F.col("bucket"), roots), F.lit("/"), "key").alias("source_file"),
                        F.coalesce("size", F.lit(0)).cast("long").alias("length"))


def stream_notices(spark: SparkSession, log: str, *, max_files: int = 1000, archive: str | None = None) -> DataFrame:
    """Messages as they appear in ``log``, one a line; read ones are moved below ``archive`` if given."""
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(log)


def land_noticed(files: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 seconds",
                 strict: bool = False, buckets: int = BUCKETS, max_parts: int = MAX_PARTS) -> StreamingQuery:
    """Lands each file of a stream of ``named_files`` once, whatever the layout of its JSON.

    Executors read the named files; nothing is listed and no names pass through the driver. A batch
    that is run again overwrites its own rows with the same ones. A file that is named but cannot be
    read fails the batch, which is run again by the next start.
    """
    spark = files.sparkSession
    seen = SeenIds(spark, f"{out}/names", "source_file", buckets=buckets, max_parts=max_parts)

    def land(batch: DataFrame, number: int) -> None:
        named = written(batch.groupBy("source_file").agg(F.max("length").alias("length")), "named")
        new = written(seen.unseen(named, number), "named-first")
        values = read_values(spark, new)
        rows = values.select(landing_row(F.col("value").cast("string"), strict=strict).alias("raw_payload"),
                             F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"), "source_file")
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        seen.add(number, new)

    writer = files.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def noticed_rows(spark: SparkSession, out: str) -> DataFrame:
    """``raw_payload, ingested_at, source_file`` of everything landed so far."""
    return spark.read.parquet(f"{out}/rows").drop("batch")
