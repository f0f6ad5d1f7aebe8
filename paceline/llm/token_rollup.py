"""Token counts: delta-maintained rollups by source, language and tokenizer version.

Totals are never recomputed. A batch of changes (inserts, deletes, revised counts) is folded into
signed sums by source, language and tokenizer, appended to a delta table and then committed by
one row in a commit table. A reader adds up the deltas of committed attempts, so a batch counts
once however often it is retried or replayed, and a job that dies between the two writes leaves
nothing that counts. Compaction folds committed batches into one that names them.

Defined results: null and empty texts have 0 tokens and still count as documents; null sources
and languages are groups of their own; repeated rows count as often as they come; an empty batch
commits and changes nothing; groups that fall to no documents and no tokens disappear.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paceline.llm import common
from paceline.sources.scratch import written

#: Fixed value: how the byte-level tokenizer cuts texts before merging.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GROUP = ("source", "lang", "tokenizer")
_DELTAS = "batch string, attempt string, source string, lang string, tokenizer string, docs long, tokens long"
_COMMITS = "batch string, attempt string, covers array<string>"


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of base64 pieces and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def count_tokens(docs: DataFrame, keep: list[Column | str], vocabulary: str) -> DataFrame:
    """``keep`` columns, ``words`` (runs without white space) and ``bpe`` (byte-level pieces).

    The vocabulary is read on the driver and broadcast: its size does not depend on the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    kept = docs.select(*keep)
    rows = docs.select(*keep, docs["text"].alias("_text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("bytes", pat_str=SPLIT_PATTERN, mergeable_ranks=shared.value, special_tokens={})
        for batch in batches:
            texts = common.texts_of(batch.column(batch.num_columns - 1))
            words = [len(t.split()) for t in texts]
            pieces = [len(encoding.encode_ordinary(t.decode())) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(words, pa.int64()), pa.array(pieces, pa.int64())],
                                             names=[*batch.schema.names[:-1], "words", "bpe"])

    zero = F.lit(0).cast("long")
    return rows.mapInArrow(counted, kept.withColumn("words", zero).withColumn("bpe", zero).schema)


def changes(counts: DataFrame, tokenizer: str, tokens: Column | str, times: Column | int = 1) -> DataFrame:
    """``times`` documents (negative: deletes) with so many tokens each."""
    times = F.lit(times) if isinstance(times, int) else times
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return counts.select("source", "lang", F.lit(tokenizer).alias("tokenizer"),
                         times.cast("long").alias("docs"), (tokens * times).cast("long").alias("tokens"))


def revised(counts: DataFrame, tokenizer: str, old: Column | str, new: Column | str,
            times: Column | int = 1) -> DataFrame:
    """Counts corrected from ``old`` to ``new``: the same documents out and in again."""
    times = F.lit(times) if isinstance(times, int) else times
    return changes(counts, tokenizer, old, -times).union(changes(counts, tokenizer, new, times))


class TokenRollup:
    """Token totals kept under ``path``, a folder all executors and later jobs can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        for table, schema in (("deltas", _DELTAS), ("commits", _COMMITS)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{table}")

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def committed(self, batch: str) -> bool:
        commits = self._table("commits", _COMMITS)
        return not commits.where((F.col("batch") == batch) | F.array_contains("covers", batch)).isEmpty()

    def apply(self, batch: str, signed: DataFrame) -> bool:
        """Adds a batch of :func:`changes`; False if it had been committed before."""
        if self.committed(batch):
            return False
        attempt = self._write(batch, signed)
        self._commit(batch, attempt, [])
        return True

    def _write(self, batch: str, signed: DataFrame) -> str:
        attempt = uuid.uuid4().hex
        sums = signed.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        (sums.select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), *GROUP, "docs", "tokens")
         .repartition(1).write.mode("append").parquet(f"{self.path}/deltas"))  # one file; the sums are made before
        return attempt

    def _commit(self, batch: str, attempt: str, covers: list[str]) -> None:
        (self.spark.createDataFrame([(batch, attempt, covers)], _COMMITS)
         .coalesce(1).write.mode("append").parquet(f"{self.path}/commits"))

    @staticmethod
    def _counting(commits: DataFrame) -> DataFrame:
        """The one attempt of each batch that counts: the first by name, and none that is covered."""
        first = commits.groupBy("batch").agg(F.min_by("covers", "attempt").alias("covers"), F.min("attempt").alias("attempt"))
        covered = first.select(F.explode("covers").alias("batch")).distinct()
        return first.select("batch", "attempt").join(covered, "batch", "left_anti")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` of all committed batches."""
        return self._totals(self._table("commits", _COMMITS))

    def _totals(self, commits: DataFrame) -> DataFrame:
        counting = self._counting(commits)  # one row for each batch since the last compaction
        return (self._table("deltas", _DELTAS).join(counting, ["batch", "attempt"], "left_semi")
                .groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs <> 0 OR tokens <> 0"))

    def compact(self) -> None:
        """Folds all committed batches into one; replays of any of them stay without effect.

        The batches that are folded and those that are named come from one read of the commits:
        a batch committed meanwhile is in neither.
        """
        commits = written(self._table("commits", _COMMITS), "commits")
        names = [r[0] for r in commits.select(F.explode(F.concat(F.array("batch"), "covers"))).distinct().collect()]
        batch = f"compacted-{uuid.uuid4().hex}"
        self._commit(batch, self._write(batch, self._totals(commits)), sorted(names))


def copies_to_delete(counts: DataFrame) -> DataFrame:
    """Rows whose text another row has too, but for the first by id, source and language.

    ``counts`` has ``text_key``; the result has the columns of counts but for the id, and
    ``times``: how many equal rows go.
    """
    alike = (counts.groupBy("text_key", "doc_id", "source", "lang", "words", "bpe").agg(F.count("*").alias("n")))
    first = alike.groupBy("text_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "source", "lang")).alias("first"))
    this = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "source", "lang")
    return (alike.join(first, "text_key").withColumn("times", F.col("n") - this.eqNullSafe(F.col("first")).cast("int"))
            .where("times > 0").select("source", "lang", "words", "bpe", "times"))
