"""Continuous landing: every new file or message is appended once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paceline.sources.landing import DATE_FOLDERS, JSON_FILES, landing_row, with_date_folders


def stream_files(spark: SparkSession, path: str, *, max_files: int = 1000,
                 multiline: bool = False) -> DataFrame:
    """New JSON files below ``path`` as they appear, a row per line (or per file)."""
    return (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", JSON_FILES)
        .option("wholetext", multiline)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )


def stream_landing(source: DataFrame, *, strict: bool = False) -> DataFrame:
    """Landing rows from any streaming source with a ``value`` column.

    A message broker's source has one (as bytes); so has the file source.
    """
    text = F.col("value").cast("string")
    return source.where(F.trim(text) != "").select(
        landing_row(text, strict=strict).alias("raw_payload"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"),
    )


def _started(rows: DataFrame, kind: str, out: str, checkpoint: str, every: str | None,
             folders: Sequence[str] = ()) -> StreamingQuery:
    writer = rows.writeStream.format(kind).outputMode("append").option("checkpointLocation", checkpoint)
    if folders:
        writer = writer.partitionBy(*folders)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(out)


def append_table(rows: DataFrame, out: str, checkpoint: str, *, every: str | None = "5 seconds") -> StreamingQuery:
    """Append to a Parquet table each ``every``; ``None`` drains what is there and stops.

    A failed write fails the micro-batch and is retried from the checkpoint: nothing is
    dropped and counted as lost.
    """
    return _started(rows, "parquet", out, checkpoint, every)


def append_ndjson(body: DataFrame, out: str, checkpoint: str, ts_col: str = "timestamp", *,
                  every: str | None = "5 seconds", files_per_date: int = 1) -> StreamingQuery:
    """Flush events each ``every`` as JSON lines under the folder of their event date.

    Each batch gathers a date into ``files_per_date`` files (rows placed by a hash of their
    contents), so a batch does not leave one file per task and date.
    """
    dated = with_date_folders(body, ts_col)
    part = F.pmod(F.xxhash64(F.to_json(F.struct(*body.columns))), F.lit(files_per_date))
    gathered = dated.repartition(*DATE_FOLDERS, part) if files_per_date > 1 else dated.repartition(*DATE_FOLDERS)
    return _started(gathered, "json", out, checkpoint, every, DATE_FOLDERS)


def drain(query: StreamingQuery, poll_seconds: float = 1.0) -> dict[str, int]:
    """Wait for an available-now query; rows read and batches run.

    A query remembers its last 100 batches only, so progress is gathered while it runs.
    A batch that fails raises here and is run again from the checkpoint by the next start.
    """
    rows: dict[int, int] = {}
    finished = False
    while not finished:
        finished = query.awaitTermination(poll_seconds)
        rows.update({p.batchId: p.numInputRows for p in query.recentProgress})
    return {"batches": len(rows), "rows": sum(rows.values())}
