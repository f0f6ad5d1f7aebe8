"""The registered queries of this package, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paceline.llm import (decontaminate, embedding_join, hard_negatives, html_text, licenses, mixing, pii, quality_trees,
                          simhash, substrings, token_rollup, toxicity, whitening)
from paceline.llm.common import held_out, read
from paceline.sources.scratch import new_dir, written

#: A demonstration key; a real run passes its own.
PII_KEY = "corpus-pseudonyms-1"

#: Where the public vocabularies lie; only the driver reads them.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    hidden = pii.pseudonymise_documents(docs, PII_KEY)
    counts = {k: F.coalesce(F.col("pii_found")[k], F.lit(0)) for k in pii.KIND_NAMES}
    return hidden.select("doc_id", sum(counts.values(), F.lit(0)).cast("long").alias("n_found"),
                         *[n.alias(f"n_{k}") for k, n in counts.items()], "text")


@query
def op2_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_licenses(spark, sf_dir):
    return licenses.scan_documents(read(spark, sf_dir, "documents"), ["doc_id"])


@query
def op4_embeddings(spark, sf_dir):
    return embedding_join.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op5_mixing(spark, sf_dir):
    mixed = mixing.mix(read(spark, sf_dir, "documents"), ["doc_id", "source"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op5_mixing"] = mixing.mix_sql()


@query
def op6_decontamination(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"))
    rows = docs.select("doc_id", decontaminate.row_key().alias("row"))
    return (rows.join(found, F.col("row") == F.col("_row"), "left")
            .select("doc_id", F.col("_row").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"), "items", "coverage"))


@query
def op7_html(spark, sf_dir):
    return html_text.extract_pages(read(spark, sf_dir, "pages"), ["page_id", "url"])


@query
def op8_simhash(spark, sf_dir):
    return simhash.simhash_components(read(spark, sf_dir, "documents"), ["doc_id"]).drop("component")


@query
def op10_token_counts(spark, sf_dir):
    """All documents under two tokenizers, then copies deleted, then the byte-level counts
    revised to include an end-of-text token; the first batch is replayed and must not count."""
    docs = read(spark, sf_dir, "documents")
    keep = ["doc_id", "source", "lang", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key")]
    counts = written(token_rollup.count_tokens(docs, keep, VOCABULARY), "token-counts")
    copies = written(token_rollup.copies_to_delete(counts), "copies")
    rollup = token_rollup.TokenRollup(spark, new_dir(spark, "token-rollup"))
    changes, times = token_rollup.changes, F.col("times")
    words = changes(counts, "words-1", "words")
    rollup.apply("load words-1", words)
    rollup.apply("load byte-bpe-50k", changes(counts, "byte-bpe-50k", "bpe"))
    rollup.apply("delete copies", changes(copies, "words-1", "words", -times).union(
        changes(copies, "byte-bpe-50k", "bpe", -times)))
    left = counts.withColumn("times", F.lit(1).cast("long")).select("source", "lang", "bpe", "times").union(
        copies.select("source", "lang", "bpe", -times))
    rollup.apply("revise byte-bpe-50k", token_rollup.revised(left, "byte-bpe-50k", "bpe", F.col("bpe") + 1, times))
    rollup.apply("load words-1", words)
    return rollup.totals()


@query
def op9_substrings(spark, sf_dir):
    found = substrings.deduplicate(read(spark, sf_dir, "documents")).drop("kept")
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


@query
def op11_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality_trees.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_trees.score_documents(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = read(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH lattice AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS alike,
           CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM lattice a JOIN lattice r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query
def op13_whitening(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings"), ["vec_id"])
