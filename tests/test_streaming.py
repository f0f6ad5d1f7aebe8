from pyspark.sql import functions as F

from conftest import START
from paceline.operators import sessions as ses
from paceline.operators.staging import stg_events
from paceline.sources import landing as land
from paceline.sources.adapter import funnel_events
from paceline.streaming import dedup, ingest, sessions as ssessions
from test_sessions import HOT, RAW, typed_events


def landed(spark, tmp_path, stg, name="landing"):
    path = str(tmp_path / name)
    land.write_ndjson(land.payload(stg), path)
    return path


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_files_are_landed_once_over_several_batches_and_restarts(spark, tmp_path):
    stg = funnel_events(typed_events(spark)).drop("ingested_at")
    first, second = stg.where("int(event_id) % 2 = 0"), stg.where("int(event_id) % 2 = 1")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    path = landed(spark, tmp_path, first)

    def go():
        rows = ingest.stream_landing(ingest.stream_files(spark, path, max_files=5))
        return ingest.drain(ingest.append_table(rows, out, state, every=None))

    ran = go()
    assert ran["batches"] > 1 and ran["rows"] == first.count()
    assert go()["rows"] == 0
    land.write_ndjson(land.payload(second), path, mode="append")
    assert go()["rows"] == second.count()
    assert same(stg_events(spark.read.parquet(out)).drop("ingested_at"), stg)


def test_session_stream_equals_batch(spark, tmp_path):
    stg = funnel_events(typed_events(spark))
    path = landed(spark, tmp_path, stg)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, path, max_files=4)))
    ran = ingest.drain(ssessions.stream_session_partials(rows, out, state, every=None))
    assert ran["batches"] > 1
    expected = ses.session_facts(stg)
    assert same(ssessions.streamed_sessions(spark, out), expected)
    ssessions.compact_partials(spark, out, ran["batches"] - 1)
    assert same(ssessions.streamed_sessions(spark, out), expected)


def test_compaction_between_two_batches_of_a_live_stream(spark, tmp_path):
    stg = funnel_events(typed_events(spark)).drop("ingested_at")
    halves = [stg.where(f"int(event_id) % 2 = {i}") for i in (0, 1)]
    path = landed(spark, tmp_path, halves[0])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, path)))
    query = ssessions.stream_session_partials(rows, out, state, every="1 second")
    try:
        query.processAllAvailable()
        ssessions.compact_partials(spark, out, query.lastProgress.batchId)
        ssessions.compact_partials(spark, out, 0)  # nothing new to fold
        assert same(ssessions.streamed_sessions(spark, out), ses.session_facts(halves[0]))
        land.write_ndjson(land.payload(halves[1]), path, mode="append")
        query.processAllAvailable()
        assert same(ssessions.streamed_sessions(spark, out), ses.session_facts(stg))
    finally:
        query.stop()


def test_more_batches_than_a_query_remembers_are_counted(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "20")
    try:
        (tmp_path / "in").mkdir()
        for i in range(50):
            (tmp_path / "in" / f"{i:02}.json").write_text(f'{{"event_id": "e{i}"}}')
        rows = ingest.stream_landing(ingest.stream_files(spark, str(tmp_path / "in"), max_files=1))
        query = ingest.append_table(rows, str(tmp_path / "out"), str(tmp_path / "state"), every=None)
        assert ingest.drain(query, poll_seconds=0.2) == {"batches": 50, "rows": 50}
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_copies_are_dropped_across_batches_and_rows_without_id_kept(spark, tmp_path, made):
    for i in range(20):
        made.add("s1", "view_homepage", 86_400 * i, event_id=f"e{i}")
        made.add("s1", "view_homepage", 86_400 * i, event_id="hot")
    made.add("s1", "view_homepage", 0, event_id=None).add("s1", "view_homepage", 0, event_id=None)
    path = landed(spark, tmp_path, made.df(spark))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    twice = ingest.stream_files(spark, path, max_files=3).unionAll(ingest.stream_files(spark, path, max_files=4))
    once = dedup.dedup_stream(stg_events(ingest.stream_landing(twice)))
    ran = ingest.drain(ingest.append_table(once, out, state, every=None))
    assert ran["batches"] > 1
    got = spark.read.parquet(out).groupBy("event_id").agg(F.count("*").alias("n")).collect()
    assert {r["event_id"]: r["n"] for r in got} == {**{f"e{i}": 1 for i in range(20)}, "hot": 1, None: 4}


def test_any_source_with_a_value_column_can_be_landed(spark, tmp_path):
    """A message broker gives bytes in ``value``."""
    (tmp_path / "in").mkdir()
    messages = spark.createDataFrame([(b'{"event_id": "m1"}',), (b"  ",)], "value binary")
    messages.write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("value binary").parquet(str(tmp_path / "in"))
    query = ingest.append_table(ingest.stream_landing(source), str(tmp_path / "out"), str(tmp_path / "state"), every=None)
    ingest.drain(query)
    staged = stg_events(spark.read.parquet(str(tmp_path / "out"))).collect()
    assert [r["event_id"] for r in staged] == ["m1"] and staged[0]["ingested_at"] > START


def test_timed_trigger(spark, tmp_path, made):
    path = landed(spark, tmp_path, made.add("s1", "view_homepage", 0).df(spark))
    rows = ingest.stream_landing(ingest.stream_files(spark, path))
    query = ingest.append_table(rows, str(tmp_path / "out"), str(tmp_path / "state"), every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "out")).count() == 1
    finally:
        query.stop()


def test_json_sink_is_dated_by_event_time(spark, tmp_path, made):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 86_400).add("s2", "view_homepage", 5)
    path = landed(spark, tmp_path, made.df(spark))
    staged = stg_events(ingest.stream_landing(ingest.stream_files(spark, path)))
    out = str(tmp_path / "out")
    ran = ingest.drain(ingest.append_ndjson(land.payload(staged), out, str(tmp_path / "state"), every=None))
    assert ran["rows"] == 3 and (tmp_path / "out" / "year=2024" / "month=05" / "day=02").is_dir()
    assert same(stg_events(land.read_landing(spark, out)).drop("ingested_at"), made.df(spark).drop("ingested_at"))
