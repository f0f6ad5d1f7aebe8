"""Raw JSON events in and out: landing scan, landing writer, file listing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paceline.sources.json_values import SPLIT_BYTES, read_values
from paceline.sources.scratch import exists
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec

# Compressed landing files keep the suffix Spark adds.
JSON_FILES = "*.{json,json.gz}"
# Between documents that span lines (JSON text sequences).
RECORD_SEPARATOR = "\u001e"
DATE_FOLDERS = ("year", "month", "day")
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def landing_row(text: Column, *, strict: bool = False) -> Column:
    """One VARIANT per JSON text. Bytes that are not UTF-8 become U+FFFD.

    Text that is not JSON becomes NULL, or fails the job when ``strict``. An outer array
    stays one value.
    """
    clean = F.make_valid_utf8(text)
    return F.parse_json(clean) if strict else F.try_parse_json(clean)


def text_files(spark: SparkSession, path: str | Sequence[str], *, multiline: bool = False,
               record_sep: str | None = None, files: str = JSON_FILES) -> DataFrame:
    """``(value, source_file)``: a row per non-blank record.

    A record is a line; with ``record_sep`` what lies between separators, so documents
    may span lines and a large file still splits; with ``multiline`` a whole file.
    """
    records = spark.read.text(
        path if isinstance(path, str) else list(path), wholetext=multiline, lineSep=record_sep,
        pathGlobFilter=files, recursiveFileLookup=True,
    )
    return (
        records.select("value", F.col("_metadata.file_path").alias("source_file"))
        .where(F.trim("value") != "")
    )


def read_landing(spark: SparkSession, path: str | Sequence[str], *, multiline: bool = False,
                 record_sep: str | None = None, strict: bool = False,
                 files: str = JSON_FILES) -> DataFrame:
    """Bulk load of JSON files: ``(raw_payload VARIANT, ingested_at)``."""
    return text_files(spark, path, multiline=multiline, record_sep=record_sep, files=files).select(
        landing_row(F.col("value"), strict=strict).alias("raw_payload"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"),
    )


def dated_folders(spark: SparkSession, path: str, first: date, last: date) -> list[str]:
    """The date folders of the days from ``first`` to ``last`` that exist below ``path``.

    Each day's folder is looked up by its name: folders of other days are not listed, however
    many there are.
    """
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    folders = [f"{path}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
    return [f for f in folders if exists(spark, f)]


def read_landing_days(spark: SparkSession, path: str, first: date, last: date, *, strict: bool = False) -> DataFrame:
    """``read_landing`` of the events of some days, from the folders ``write_ndjson`` makes."""
    folders = dated_folders(spark, path, first, last)
    if not folders:
        return spark.createDataFrame([], "raw_payload variant, ingested_at timestamp_ntz")
    return read_landing(spark, folders, strict=strict)


def landing_table(spark: SparkSession, name: str, first: date | None = None, last: date | None = None, *,
                  text: str = "value", strict: bool = False) -> DataFrame:
    """Landing rows of a catalog table: one with a ``raw_payload`` VARIANT, or with JSON text in ``text``.

    ``first`` and ``last`` limit a table partitioned by year, month and day to these days; only
    their partitions are read.
    """
    rows = spark.table(name)
    if first or last:
        year, month, day = (F.col(c).cast("int") for c in DATE_FOLDERS)
        number = year * 10000 + month * 100 + day
        rows = rows.where(number.between(int(f"{first or date.min:%Y%m%d}"), int(f"{last or date.max:%Y%m%d}")))
    loaded = F.col("ingested_at") if "ingested_at" in rows.columns else F.current_timestamp().cast("timestamp_ntz")
    payload_ = F.col("raw_payload") if "raw_payload" in rows.columns else landing_row(F.col(text).cast("string"), strict=strict)
    return rows.select(payload_.alias("raw_payload"), loaded.alias("ingested_at"))


def list_files(spark: SparkSession, path: str | Sequence[str], files: str = JSON_FILES) -> DataFrame:
    """Every landed file below ``path``; only names and sizes are read, not contents."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files)
        .load(path if isinstance(path, str) else list(path))
        .select(F.col("path").alias("source_file"), "length", "modificationTime")
    )


def read_mixed(spark: SparkSession, path: str | Sequence[str], *, strict: bool = False, files: str = JSON_FILES,
               split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Bulk load like ``read_landing``, a row per JSON value whatever the layout of the files.

    Lines, indented values and arrays may stand in one file, and a large file is read in
    ranges of ``split_bytes`` whatever its layout.
    """
    values = read_values(spark, list_files(spark, path, files), split_bytes=split_bytes)
    return values.select(
        landing_row(F.col("value").cast("string"), strict=strict).alias("raw_payload"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"),
    )


def payload(events: DataFrame, experiment_id: str | None = None,
            spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Typed events back to the nested producer layout."""
    return events.select(
        F.col(spec.event_id).alias("event_id"),
        F.col(spec.user).alias("user_id"),
        F.col(spec.session).alias("session_id"),
        F.col(spec.event_type).alias("event_type"),
        F.date_format(spec.event_ts, ISO_MICROS).alias("timestamp"),
        F.col(spec.device).alias("device"),
        F.lit(experiment_id).cast("string").alias("experiment_id"),
        F.struct(
            F.col(spec.channel).alias("acquisition_channel"),
            F.date_format(spec.signup, "yyyy-MM-dd").alias("signup_date"),
            F.col(spec.variant).alias("experiment_variant"),
        ).alias("customer_metadata"),
    )


def landing_from_events(events: DataFrame, experiment_id: str | None = None,
                        spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """The landing rows the producer's JSON would give, without touching files."""
    body = payload(events, experiment_id, spec)
    return body.select(
        landing_row(F.to_json(F.struct(*body.columns)), strict=True).alias("raw_payload"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"),
    )


def with_date_folders(body: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Adds zero-padded year, month and day of the *event* time."""
    ts = F.col(ts_col).cast("timestamp_ntz")
    return body.select("*", *[
        F.date_format(ts, pattern).alias(name) for name, pattern in zip(DATE_FOLDERS, ("yyyy", "MM", "dd"))
    ])


def write_ndjson(body: DataFrame, path: str, ts_col: str = "timestamp", *,
                 compression: str = "none", mode: str = "errorifexists") -> None:
    """One JSON object per line under ``year=/month=/day=`` of the event time.

    The rebalance hint lets adaptive execution gather each date into few files and still
    split a date that holds much of the data, so a hot day is not one writer's job.
    """
    dated = with_date_folders(body, ts_col).hint("rebalance", *DATE_FOLDERS)
    dated.write.mode(mode).partitionBy(*DATE_FOLDERS).option("compression", compression).json(path)


def write_documents(body: DataFrame, path: str) -> None:
    """Indented JSON documents, many to a file, between record separators."""
    pretty = F.to_json(F.struct(*body.columns), {"pretty": "true"})
    body.select(pretty.alias("value")).write.option("lineSep", RECORD_SEPARATOR).text(path)


def landing_counts(landing: DataFrame) -> DataFrame:
    """Rows, parsed rows and the load window of a landing table, in one pass."""
    return landing.agg(
        F.count(F.lit(1)).alias("landed_rows"),
        F.count("raw_payload").alias("parsed_rows"),
        F.count_if(F.expr("try_variant_get(raw_payload, '$.event_id', 'string')").isNotNull()).alias("rows_with_id"),
        F.min("ingested_at").alias("first_load"),
        F.max("ingested_at").alias("last_load"),
    )
