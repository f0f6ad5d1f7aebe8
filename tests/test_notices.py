"""Landing by notification."""

import json
from urllib.parse import quote_plus

import pytest
from pyspark.errors import StreamingQueryException

from paceline.operators.staging import stg_events
from paceline.sources import landing as land
from paceline.streaming import ingest, notices

from test_binding import month_of_events


def message(*keys, bucket="clicks", event="ObjectCreated:Put", size=None):
    return json.dumps({"Records": [{"eventName": event, "s3": {"bucket": {"name": bucket}, "object": {"key": k, "size": size}}} for k in keys]})


@pytest.fixture
def landing(spark, tmp_path):
    path = tmp_path / "landing"
    land.write_ndjson(land.payload(month_of_events().df(spark)), str(path))
    log = tmp_path / "log"
    log.mkdir()
    files = sorted(str(f.relative_to(path)) for f in path.rglob("*.json"))
    return path, log, files


def run(spark, tmp_path, landing, **options):
    path, log, _ = landing
    out = str(tmp_path / "out")
    files = notices.named_files(notices.stream_notices(spark, str(log), max_files=1, **options), {"clicks": str(path)})
    return ingest.drain(notices.land_noticed(files, out, str(tmp_path / "state"), every=None, buckets=4, max_parts=2)), out


def test_named_files_only_and_once_over_restarts(spark, tmp_path, landing):
    path, log, files = landing
    assert len(files) == 20
    keys = [quote_plus(f, safe="/") for f in files]
    (log / "1").write_text(message(*keys[:5]) + "\n" + message(keys[0], keys[1]) + "\nno message\n\n")
    (log / "2").write_text(message(*keys[3:8], size=10**6) + "\n")
    first, out = run(spark, tmp_path, landing)
    assert first["batches"] == 2 and notices.noticed_rows(spark, out).count() == 8
    (log / "3").write_text(message(*keys[:12]) + "\n")
    (log / "4").write_text(message(keys[15], event="ObjectRemoved:Delete") + "\n" + message("a.parquet") + "\n{}\n")
    (log / "5").write_text(message(keys[2], keys[11]) + "\n")
    second, out = run(spark, tmp_path, landing)
    rows = notices.noticed_rows(spark, out)
    assert second["batches"] == 3 and rows.count() == 12 == rows.select("source_file").distinct().count()
    assert stg_events(rows).select("event_id").distinct().count() == 12
    assert run(spark, tmp_path, landing)[0]["rows"] == 0


def test_a_file_that_cannot_be_read_fails_its_batch_and_lands_later(spark, tmp_path, landing):
    path, log, files = landing
    late = path / "late.json"
    (log / "1").write_text(message(files[0], "late.json") + "\n")
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, landing)
    late.write_text('{\n "event_id": "e-late",\n "user_id": "u"\n}\n')
    run(spark, tmp_path, landing)
    rows = notices.noticed_rows(spark, str(tmp_path / "out"))
    assert rows.count() == 2 and rows.where("source_file LIKE '%late.json'").count() == 1


def test_buckets_without_a_root_are_object_store_paths(spark):
    rows = spark.createDataFrame([(message("a+b/c%3D1.json", bucket="other"),), ("[]",), (None,), ('{"Records": [{}]}',)], "value string")
    assert [tuple(r) for r in notices.named_files(rows, {"clicks": "/x"}).collect()] == [("s3a://other/a b/c=1.json", 0)]
