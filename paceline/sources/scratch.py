"""Intermediate tables in the folder all executors share.

A written table survives executor loss and is read back with column pruning, which is
why it is used instead of caching for anything read more than once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="paceline-")
    return _local_dirs[sc.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/paceline/{app}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and shares the work."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as it wants it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    files, where = _hadoop(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder and all below it, if it exists."""
    files, where = _hadoop(spark, path)
    files.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _hadoop(spark, path)
    return files.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes (or overwrites) a small file."""
    files, where = _hadoop(spark, path)
    out = files.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
