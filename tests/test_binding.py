"""Sources by day and by name, and durable counts of flushes."""

from datetime import date, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import Events, plan
from paceline.operators.staging import stg_events
from paceline.plans.build import job_input
from paceline.sources import landing as land
from paceline.streaming import counts


def month_of_events():
    made = Events()
    for d in range(20):
        made.add("s", "view_homepage", d * 86400)
    return made


def test_a_day_is_loaded_from_its_folder_alone(spark, tmp_path):
    path = str(tmp_path / "landing")
    land.write_ndjson(land.payload(month_of_events().df(spark)), path)
    day = date(2024, 5, 4)
    one = land.read_landing_days(spark, path, day, day)
    assert one.count() == 1 and {f.split("/day=")[1][:2] for f in one.inputFiles()} == {"04"}
    assert land.dated_folders(spark, path, day, day + timedelta(days=2)) == [f"{path}/year=2024/month=05/day=0{n}" for n in (4, 5, 6)]
    assert land.read_landing_days(spark, path, date(2030, 1, 1), date(2030, 1, 9)).count() == 0
    assert job_input(spark, path, first=day, last=date(2024, 5, 30)).count() == 17
    assert job_input(spark, path).count() == job_input(spark, path, mixed=True).count() == 20
    with pytest.raises(ValueError):
        job_input(spark, path, first=day)


def test_a_table_is_bound_by_name_and_pruned_by_date(spark, tmp_path):
    body = land.with_date_folders(land.payload(month_of_events().df(spark)))
    text = F.to_json(F.struct(*[c for c in body.columns if c not in land.DATE_FOLDERS])).alias("value")
    rows = body.select(text, *land.DATE_FOLDERS)
    rows.write.partitionBy(*land.DATE_FOLDERS).option("path", str(tmp_path / "t")).saveAsTable("bound_text")
    try:
        some = land.landing_table(spark, "bound_text", date(2024, 5, 3), date(2024, 5, 7))
        assert stg_events(some).count() == 5 and "PartitionFilters: [" in plan(some)
        assert job_input(spark, "bound_text", table=True).count() == 20
        assert job_input(spark, "bound_text", table=True, first=date(2024, 5, 19)).count() == 2
        land.landing_table(spark, "bound_text").write.option("path", str(tmp_path / "v")).saveAsTable("bound_variant")
        assert stg_events(land.landing_table(spark, "bound_variant")).count() == 20
    finally:
        for name in ("bound_text", "bound_variant"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_counts_outlive_more_batches_than_a_query_remembers(spark, tmp_path):
    source, out, state, kept = (str(tmp_path / n) for n in ("in", "out", "state", "kept"))
    spark.range(0, 110, 1, 110).write.parquet(source)  # a file for each row
    rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    failed = []

    def flush(batch, number):
        if number == 60 and not failed:
            failed.append(number)
            raise RuntimeError("planted")
        batch.count()

    listener = counts.FlushCounts(spark, kept)
    spark.streams.addListener(listener)
    try:
        for _ in range(2):
            query = rows.writeStream.foreachBatch(flush).option("checkpointLocation", state).trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except StreamingQueryException:
                assert len(failed) == 1
            listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    total = counts.flush_counts(spark, kept).collect()
    assert [(r["runs"], r["batches"], r["rows"], r["failures"]) for r in total] == [(2, 110, 110, 1)]
    runs = {r["batches"]: r["error"] for r in counts.run_counts(spark, kept).collect()}
    assert sorted(runs) == [50, 60] and "planted" in runs[60] and runs[50] is None
