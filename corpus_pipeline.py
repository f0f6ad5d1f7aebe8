"""The corpus pipeline: documents to a mixed training set, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last keep the columns of documents;
the last adds ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paceline.llm import decontaminate, mixing, pii, simhash, toxicity
from paceline.llm.common import read
from paceline.llm.queries import PII_KEY
from paceline.sources.scratch import written


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents scored 0.5 or more; the model learns from this stage's documents."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    score = _fresh(docs, "score")
    scored = toxicity.score_documents(docs, model, [*docs.columns], score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest id, nulls last.

    Rows of equal id are told apart by their text; of fully repeated rows one stays.
    """
    row = decontaminate.row_key()
    named = simhash.simhash_components(docs, ["doc_id", row.alias("row")])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    kept = named.groupBy("component").agg(first).select(F.col("first.row").alias("kept_row"))
    name = _fresh(docs, "row")
    rows = docs.withColumn(name, row).join(kept, F.col(name) == F.col("kept_row"), "left_semi")
    return rows.dropDuplicates([name]).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    name = _fresh(docs, "row")
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")).select(F.col("_row").alias(name + "_"))
    rows = docs.withColumn(name, decontaminate.row_key())
    return rows.join(found, F.col(name) == F.col(name + "_"), "left_anti").select(*docs.columns)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers and dates become pseudonyms; no document goes."""
    hidden = pii.pseudonymise_documents(docs, PII_KEY, found=_fresh(docs, "found"))
    return hidden.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes words from, with the number of words taken."""
    return mixing.mix(docs, docs.columns).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", hide_personal),
    ("mixing", mix_sources),
]

#: The first stage is a trained model: no SQL. The tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
