import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from paceline.operators.staging import dedup_events, stg_events
from paceline.sources import landing as land
from paceline.sources.scratch import new_dir, shared_dir, written


def payload(i, **over):
    return {"event_id": f"e{i}", "user_id": "usr_1", "session_id": "s1", "event_type": "view_homepage",
            "timestamp": "2024-05-01T10:00:00.250000", "device": "mobile", "experiment_id": "x",
            "customer_metadata": {"acquisition_channel": "Email", "signup_date": "2024-05-01",
                                  "experiment_variant": "control"}, **over}


def test_scan_skips_blank_lines_and_keeps_an_array_as_one_row(spark, tmp_path):
    lines = [json.dumps(payload(1)), "", "   ", "{not json", json.dumps([payload(2), payload(3)])]
    (tmp_path / "a.json").write_text("\n".join(lines))
    (tmp_path / "skip.csv").write_text("no,json")
    landing = land.read_landing(spark, str(tmp_path))
    assert landing.count() == 3
    staged = stg_events(landing)
    assert [r["event_id"] for r in rows(staged.where("event_id is not null"))] == ["e1"]
    counts = rows(land.landing_counts(landing))[0]
    assert (counts["landed_rows"], counts["parsed_rows"], counts["rows_with_id"]) == (3, 2, 1)


def test_strict_landing_fails_on_bad_json(spark, tmp_path):
    (tmp_path / "a.json").write_text("{not json")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|parse"):
        land.read_landing(spark, str(tmp_path), strict=True).collect()


def test_bytes_that_are_not_utf8_are_replaced(spark, tmp_path):
    body = json.dumps(payload(1, device="DEV")).encode().replace(b"DEV", b"mo\xffbile")
    (tmp_path / "a.json").write_bytes(body)
    assert rows(stg_events(land.read_landing(spark, str(tmp_path))))[0]["device"] == "mo�bile"


def test_one_indented_object_per_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"event_{i}.json").write_text(json.dumps(payload(i), indent=2))
    staged = stg_events(land.read_landing(spark, str(tmp_path), multiline=True))
    assert sorted(r["event_id"] for r in rows(staged)) == ["e0", "e1", "e2"]


def test_minimal_payload_stages_as_nulls(spark, tmp_path):
    whole = payload(8)
    (tmp_path / "a.json").write_text(json.dumps({k: whole[k] for k in ("event_id", "event_type")}))
    row = rows(stg_events(land.read_landing(spark, str(tmp_path))))[0]
    assert row["event_id"] == whole["event_id"] and row["event_type"] == whole["event_type"]
    assert all(row[c] is None for c in ("user_id", "event_timestamp", "variant", "signup_date"))


def test_bad_cast_fails_unless_lenient(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(payload(1, timestamp="yesterday")))
    landing = land.read_landing(spark, str(tmp_path))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        stg_events(landing).collect()
    assert rows(stg_events(landing, strict=False))[0]["event_timestamp"] is None


def test_types_and_microseconds_survive(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(payload(1)))
    staged = stg_events(land.read_landing(spark, str(tmp_path)))
    assert dict(staged.dtypes)["event_timestamp"] == "timestamp_ntz"
    assert dict(staged.dtypes)["signup_date"] == "date"
    assert rows(staged)[0]["event_timestamp"] == datetime(2024, 5, 1, 10, 0, 0, 250000)


def test_written_files_are_dated_by_event_time_and_read_back(spark, made, tmp_path):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 86_400).add("s2", "view_homepage", 9, device=None)
    stg = made.df(spark)
    out = str(tmp_path / "landing")
    land.write_ndjson(land.payload(stg, "exp"), out)
    assert (tmp_path / "landing" / "year=2024" / "month=05" / "day=01").is_dir()
    assert (tmp_path / "landing" / "year=2024" / "month=05" / "day=02").is_dir()
    files = land.list_files(spark, out)
    assert files.count() >= 2 and rows(files)[0]["length"] > 0
    back = stg_events(land.read_landing(spark, out)).drop("ingested_at")
    assert sorted(map(str, back.collect())) == sorted(map(str, stg.select(back.columns).collect()))


def test_a_date_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    """The rebalance splits a heavy date instead of giving it to one writer."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        day = spark.range(0, 60_000, 1, 8).select(
            F.col("id").cast("string").alias("event_id"), F.sha2(F.col("id").cast("string"), 512).alias("user_id"),
            F.lit("2024-05-01T00:00:00").alias("timestamp"))
        land.write_ndjson(day, str(tmp_path / "hot"))
        assert land.list_files(spark, str(tmp_path / "hot")).count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_dedup_keeps_one_copy_and_all_rows_without_id(spark, made):
    made.add("s1", "view_homepage", 0, event_id="a").add("s1", "view_homepage", 0, event_id="a")
    made.add("s1", "search_product", 1, event_id="b")
    made.add("s1", "search_product", 1, event_id=None).add("s1", "search_product", 1, event_id=None)
    assert sorted(str(r["event_id"]) for r in rows(dedup_events(made.df(spark)))) == ["None", "None", "a", "b"]


def test_differing_copies_of_one_load_always_give_the_same_row(spark, made):
    for device in ("tablet", "mobile", "desktop"):
        made.add("s1", "view_homepage", 0, event_id="a", device=device)
    stg = made.df(spark)
    assert {rows(dedup_events(stg.repartition(n)))[0]["device"] for n in (1, 2, 5)} == {"desktop"}


def test_scratch_uses_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_dir(spark, "x").startswith(shared_dir(spark)) and new_dir(spark, "x") != new_dir(spark, "x")
    df = spark.range(5)
    assert written(df, "numbers").count() == 5
