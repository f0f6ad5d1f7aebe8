import duckdb
import pytest

from conftest import SMALL, rows
from pyspark.sql import Window, functions as F

from paceline.plans import build, catalog
from paceline.session import size_shuffles
from paceline.sources import landing as land


@pytest.fixture(scope="module")
def staged(spark):
    """Events made to pass the data tests: each step of a session at most once and in order,
    and no device missing."""
    stg = catalog.events(spark, SMALL)
    first = Window.partitionBy("session_id").orderBy("event_timestamp", "event_id")
    return (stg.withColumn("place", F.row_number().over(first)).where("place <= 6")
            .withColumn("event_type", F.element_at(F.array(*[F.lit(x.event) for x in catalog.SPEC.steps]), F.col("place")))
            .withColumn("device", F.coalesce("device", F.lit("mobile"))).drop("place"))


def test_whole_job_from_files_to_readout(spark, staged, tmp_path):
    src = str(tmp_path / "src")
    land.write_ndjson(land.payload(staged), src)
    done = build.run_job(spark, src, str(tmp_path / "out"))
    assert {r["table_name"]: r["row_count"] for r in rows(build.table_counts(
        {k: done[k] for k in ("stg_events", "int_sessions", "fct_ab_test_summary")}))} == {
        "stg_events": staged.count(), "int_sessions": 492, "fct_ab_test_summary": 2}
    assert done["data_tests"].count() == 93 and done["data_tests"].where("failures > 0").count() == 0
    assert done["srm_check"].count() == 1 and done["covariate_balance"].count() == 2 and done["hte_logit"].count() > 0
    build.register_views({k: done[k] for k in ("fct_ab_test_summary",)})
    assert spark.sql("select sum(total_sessions) from fct_ab_test_summary").first()[0] == 492
    # A second run replaces every table.
    again = build.run_job(spark, src, str(tmp_path / "out"), dedup=True)
    assert again["stg_events"].count() == staged.count()


def test_exploration_reads_the_tables_of_the_job(spark, staged, tmp_path):
    out = str(tmp_path / "out")
    tables = build.build_tables(staged, out)
    done = build.explore(tables, out)
    arms = tables["int_sessions"].select("variant").distinct().count()
    first = done["km_conversion"].groupBy("variant").agg(F.max("at_risk").alias("sessions"))
    assert first.count() == arms and sum(r["sessions"] for r in first.collect()) == tables["int_sessions"].count()
    users = staged.select("user_id").distinct().count()
    assert done["user_features"].count() == users
    assert sum(r["users"] for r in done["user_segments"].collect()) == users
    assert done["kmeans_sweep"].count() > 1 and done["population_verdict"].count() == 1
    assert {r["transition"] for r in done["km_step_transitions"].collect()} == {g.removesuffix("_seconds") for _, _, g in catalog.SPEC.hops}
    assert spark.read.parquet(f"{out}/power_plan").count() == done["power_plan"].count() > 0


def test_double_load_fails_the_data_tests_unless_deduplicated(spark, staged, tmp_path):
    src = str(tmp_path / "src")
    land.write_ndjson(land.payload(staged), src)
    land.write_ndjson(land.payload(staged), src, mode="append")
    with pytest.raises(build.DataTestFailure, match="stg_events.event_id unique"):
        build.run_job(spark, src, str(tmp_path / "out"))
    done = build.run_job(spark, src, str(tmp_path / "out2"), dedup=True)
    assert done["data_tests"].where("failures > 0").count() == 0


def test_shared_session_ids_use_the_general_forms(spark, made, tmp_path):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 5, user_id="u2")
    made.add("s2", "view_homepage", 0)
    tables = build.build_tables(made.df(spark), str(tmp_path / "out"))
    assert tables["int_step_transition"].count() == 3
    assert rows(tables["fct_ab_test_summary"])[0]["total_sessions"] == 2
    assert rows(tables["int_step_transition"].where("session_id = 's1'").select("homepage_to_search_seconds").distinct()) \
        == [{"homepage_to_search_seconds": 5}]


def test_catalog_tables(spark, made):
    spark.sql("create database if not exists published")
    df = made.add("s1", "view_homepage", 0).df(spark)
    build.save_as_tables({"stg_events": df}, "published")
    build.save_as_tables({"stg_events": df}, "published")
    assert spark.table("published.stg_events").count() == 1


def test_shuffle_sizing_only_raises(spark, monkeypatch):
    import paceline.session as s

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    assert size_shuffles(spark, SMALL) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) == before
    monkeypatch.setattr(s, "_sized", {})
    monkeypatch.setattr(s, "SHUFFLE_PARTITION_BYTES", 10_000)
    try:
        assert size_shuffles(spark, SMALL) > 20
        assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) > 20
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.mark.parametrize("name", ["int_sessions", "fct_conversion_funnel", "fct_session_dropoff", "fct_user_retention",
                                  "fct_ab_transitions", "km_step_transitions", "covariate_balance", "hte_main_effect",
                                  "chapman_users", "silhouette_sampled", "stream_dedup"])
def test_registered_queries_match_their_sql(spark, name):
    import glob
    import os

    from check_oracle import compare

    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    ok, note = compare(spark, con, name, SMALL)
    assert ok, note


def test_every_query_has_sql_or_a_reason():
    from __spark_entry__ import oracle_sql, queries

    # Iterative fits, and file names that differ from run to run; corpus operators have their own tests.
    library = set(catalog.QUERIES)
    assert library <= set(queries())
    assert library - set(oracle_sql()) == {"hte_logit", "kmeans_sweep", "kmeans_segments", "chapman_files"}
    assert set(oracle_sql()) <= set(queries())
