"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

# Runtime SQL settings; each can be overridden by the cluster's own configuration.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every column expression doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Target size of one shuffle partition and the most partitions worth asking for.
SHUFFLE_PARTITION_BYTES = 64 << 20
MAX_SHUFFLE_PARTITIONS = 100_000
# Parquet is compressed and columnar; rows in a shuffle are neither.
SHUFFLE_GROWTH = 3

_sized: dict[tuple[str, str], int] = {}


def get_session(app_name: str = "paceline", **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Second gaps and day differences go through zoned timestamps: pin the zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def size_shuffles(spark: SparkSession, path: str) -> int:
    """Raise the initial shuffle partition count to suit the input at ``path``.

    Only raises: adaptive execution merges small partitions back at run time, so asking
    for too many costs little while asking for too few spills. Returns the count in force.
    """
    seen = (spark.sparkContext.applicationId, path)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if seen not in _sized:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        total = listing.agg(F.sum("length")).first()[0] or 0
        _sized[seen] = min(MAX_SHUFFLE_PARTITIONS, total * SHUFFLE_GROWTH // SHUFFLE_PARTITION_BYTES)
    wanted = max(current, _sized[seen])
    if wanted > current:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted
