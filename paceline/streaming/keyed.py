"""Tables kept by key beside a stream, and pointers that switch readers at once.

A keyed table lies in hash buckets. A micro-batch adds a part to the buckets it touches; a bucket
that has :attr:`KeyedTable.max_parts` of them is folded into one instead, so what a reader or a
probe reads never grows with the number of batches. Which parts count is one small manifest;
writing it is the commit. A batch that is killed before leaves the old manifest in force, and
one that is run again overwrites its own parts; one that is run again after its commit changes
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

BUCKETS, MAX_PARTS = 64, 8


class Pointer:
    """The last two versions of a few rows, in two slots that are overwritten in turn.

    A slot is one file, so a version is there as a whole or not at all, and the slot in force
    is never the one that is written.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def versions(self) -> list[tuple[int, list[Row]]]:
        """(number, rows), the newest first."""
        try:
            rows = (self.spark.read.schema(f"version long, {self.schema}").option("ignoreMissingFiles", "true")
                    .parquet(self.path).collect())
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        found: dict[int, list[Row]] = {}
        for r in rows:
            found.setdefault(r["version"], []).append(r)
        return sorted(found.items(), reverse=True)

    def put(self, rows: Sequence[tuple]) -> int:
        """Makes ``rows`` (at least one) the newest version."""
        newest = self.versions()
        version = newest[0][0] + 1 if newest else 0
        df = self.spark.createDataFrame([(version, *r) for r in rows], f"version long, {self.schema}")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/slot={version % 2}")
        return version


@dataclass(frozen=True)
class State:
    """The last batch that counts, and the parts of each bucket."""

    batch: int
    parts: dict[int, tuple[str, ...]]


class KeyedTable:
    """Rows by ``keys``; ``merge`` folds rows of equal keys and must not mind their order.

    ``buckets`` must stay the same for the life of a table; a bucket is what one batch rewrites
    at most every ``max_parts`` batches.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], merge: Callable[[DataFrame], DataFrame], *,
                 buckets: int = BUCKETS, max_parts: int = MAX_PARTS):
        self.spark, self.path, self.keys, self.merge = spark, path, list(keys), merge
        self.buckets, self.max_parts = buckets, max_parts
        self.manifest = Pointer(spark, f"{path}/manifest", "batch long, bucket int, part string")

    def states(self) -> list[State]:
        """The state in force and the one before."""
        out = []
        for _, rows in self.manifest.versions():
            parts: dict[int, list[str]] = {}
            for r in rows:
                if r["part"] is not None:
                    parts.setdefault(r["bucket"], []).append(r["part"])
            out.append(State(rows[0]["batch"], {b: tuple(sorted(p)) for b, p in parts.items()}))
        return out

    def state(self, before: int | None = None) -> State:
        """The state in force, or as it was before batch ``before`` (the last or the next one)."""
        known = [s for s in self.states() if before is None or s.batch < before]
        return known[0] if known else State(-1, {})

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def rows(self, state: State | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """Unmerged rows with their ``bucket``, of some buckets only if given; None if there are none."""
        state = state or self.state()
        wanted = state.parts if buckets is None else [b for b in buckets if b in state.parts]
        paths = [f"{self.path}/data/part={p}/bucket={b}" for b in wanted for p in state.parts[b]]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths).drop("part")

    def read(self) -> DataFrame | None:
        """The table: one row per key."""
        rows = self.rows()
        return None if rows is None else self.merge(rows.drop("bucket"))

    def _write(self, rows: DataFrame, part: str) -> list[int]:
        """Writes a part by bucket; the buckets it holds (at most ``buckets`` numbers)."""
        path = f"{self.path}/data/part={part}"
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        kept = self.spark.read.schema("bucket int").parquet(path)
        return sorted(r["bucket"] for r in kept.select("bucket").distinct().collect())

    def apply(self, batch: int, delta: DataFrame, with_part: Callable[[str], None] | None = None) -> State:
        """Merges ``delta`` in, once for each batch number; numbers must rise.

        ``with_part`` is called for every part after it is written and before it counts.
        """
        state = self.state()
        if batch <= state.batch:
            return state
        with_part = with_part or (lambda part: None)
        added = f"batch-{batch}"
        touched = self._write(self.merge(delta), added)
        if touched:
            with_part(added)
        full = [b for b in touched if len(state.parts.get(b, ())) + 1 >= self.max_parts]
        parts = {**state.parts, **{b: (*state.parts.get(b, ()), added) for b in touched}}
        if full:
            folded = f"fold-{batch}"
            whole = self.rows(State(batch, parts), full)
            self._write(self.merge(whole.drop("bucket")), folded)
            with_part(folded)
            parts.update({b: (folded,) for b in full})
        rows = [(batch, b, p) for b, names in parts.items() for p in names]
        self.manifest.put(rows or [(batch, None, None)])
        return State(batch, parts)
