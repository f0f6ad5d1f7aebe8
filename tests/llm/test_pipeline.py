"""The pipeline end to end, on a small table with planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paceline.llm import mixing, queries


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    rng = random.Random(11)
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    item = prose(25)
    rows = [(i, prose(80) + (f" trash {prose(5)}" if i % 5 == 0 else "")) for i in range(300)]
    near = prose(200)
    rows += [(1000, near), (1001, near), (1002, near), (2000, prose(40) + " " + item + " " + prose(10)),
             (3000, "mail joe.black@example.com " + prose(50)), (4000, None), (4001, "")]
    docs = spark.createDataFrame([(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("extra", F.lit("e")).withColumn("score", F.lit("clash")).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages_keep_columns_and_take_effect(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == columns
    toxic = {i for i in range(300) if i % 5 == 0}
    assert len(toxic & set(left["toxicity"])) <= 3 and len(left["toxicity"]) >= 240
    assert {1000, 1001, 1002} & set(left["simhash"]) == {1000}
    assert 2000 in left["simhash"] and 2000 not in left["decontamination"]
    assert set(left["simhash"]) - set(left["decontamination"]) == {2000}
    assert "joe.black@" not in left["pii"][3000] and "@example.com" in left["pii"][3000]
    assert set(left["pii"]) == set(left["decontamination"])
    assert {*mixing.OUTPUTS} <= set(docs.columns)


def test_run_is_repeatable_and_handles_no_documents(spark, corpus, tmp_path):
    first = corpus_pipeline.run(spark, corpus)
    again = corpus_pipeline.run(spark, corpus)
    assert first.exceptAll(again).count() == 0 == again.exceptAll(first).count()
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus).count() == 0


def test_mix_matches_its_sql(spark, corpus):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{corpus}/documents.parquet/*.parquet'")
    rows = queries.QUERIES["op5_mixing"](spark, corpus).collect()
    expected = con.execute(queries.ORACLE["op5_mixing"]).fetchall()
    assert sorted(tuple(r) for r in rows) == sorted(expected)
