"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Keys are cut into ranges, sizes are summed by source
and range, and the ranges' running totals give every range its offset; documents are then
ordered only within their range, so that no task ever holds a whole source. A source whose
target exceeds its size repeats whole epochs and then starts the next one in key order, cut at
the exact budget: the document at the cut is taken in part.

Defined results: a null text has size 0; a null source is a source of its own, last in order;
rows with equal id, size and text are interchangeable; sources without words have target 0; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.sources.scratch import written

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
RANGE_DIGITS = 4  # hexadecimal digits of a key that name its range: 65,536 ranges


def n_words(text: Column) -> Column:
    """Runs of bytes other than white space (0x20, 0x09 to 0x0D)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")).cast("long")


def hash_key(doc_id: Column) -> Column:
    """The order of documents in a mix: md5 of the id, the same in every run."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``source, source_size, target``: weights shared out, capped, and the excess reshared.

    A source is capped where its weighted part exceeds ``most`` times its size. In order of
    cap per weight the capped sources come first, so running totals find the level at which
    the rest share what remains. Windows here run over one row for each source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most))))
    by_cap = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    rows = (rows.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("capped", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open")))
    # The first source whose limit is not exceeded sets the level for itself and all after it.
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("capped", "level"))).over(everything)
    target = F.least("limit", F.coalesce(level["level"] * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.alias("target"))


OUTPUTS = ("size", "source_size", "target", "taken")


def mix(docs: DataFrame, keep: list[str], weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``keep`` columns with ``size``, ``source_size``, ``target`` and ``taken`` words.

    Kept columns named like one of these four are replaced by it.
    """
    keep = [c for c in keep if c not in OUTPUTS]
    key = hash_key(F.col("doc_id"))
    sized = written(docs.select(
        F.struct(*keep).alias("kept"), "source", n_words(F.col("text")).alias("size"), key.alias("key"),
        F.substring(key, 1, RANGE_DIGITS).alias("span"), F.xxhash64("text").alias("tie")), "sizes")
    targets = source_targets(sized, weights, share, most).withColumnRenamed("source", "of_source")

    sums = sized.groupBy("source", "span").agg(F.sum("size").alias("total"))
    up_to = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("in_source"), F.col("span").alias("in_span"),
                          F.coalesce(F.sum("total").over(up_to), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets, F.col("in_source").eqNullSafe(F.col("of_source")))
    rows = sized.join(offsets, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("span") == F.col("in_span")))

    inside = (Window.partitionBy("source", "span").orderBy("key", "size", "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    partly = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("kept.*", "size", "source_size", "target",
                       (epochs * F.col("size") + partly).cast("long").alias("taken"))


def mix_sql(table: str = "documents", weights=WEIGHTS, share=SHARE, most=MOST) -> str:
    """The same rows in SQL, with one window over each whole source.

    The level is searched as the smallest feasible one instead of by running totals.
    """
    listed = ", ".join(map(str, weights))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM {table}),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{listed}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT a.source,
         ((SELECT sum(source_size) FROM per_source) * {share}::DOUBLE
          - coalesce(sum({most}::DOUBLE * b.source_size)
              FILTER (WHERE {most}::DOUBLE * b.source_size / b.weight < {most}::DOUBLE * a.source_size / a.weight), 0))
         / sum(b.weight) FILTER (WHERE {most}::DOUBLE * b.source_size / b.weight >= {most}::DOUBLE * a.source_size / a.weight)
         AS level, {most}::DOUBLE * a.source_size / a.weight AS cap
  FROM per_source a, per_source b GROUP BY a.source, a.source_size, a.weight),
targets AS (
  SELECT source, source_size,
         least({most}::DOUBLE * source_size,
               coalesce((SELECT level FROM levels WHERE level <= cap ORDER BY cap LIMIT 1) * weight,
                        {most}::DOUBLE * source_size)) AS target
  FROM per_source),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM placed"""
