import random
from datetime import datetime, timedelta

import pytest

from conftest import START, plan, rows
from paceline.operators import sessions as ses
from pyspark.sql import functions as F

from paceline.operators.sessionize import session_openers, sessionize
from paceline.sources.adapter import funnel_events

RAW = "event_id long, ts timestamp_ntz, user_id long"


def typed_events(spark):
    """The raw events with their type, all five types in every session."""
    kinds = F.array(*[F.lit(k) for k in ("view", "click", "error", "purchase", "signup")])
    return spark.createDataFrame(HOT, RAW).withColumn("event_type", F.get(kinds, F.abs(F.col("event_id")).cast("int") % 5))


def raw_events(n, users, seed, hours=24 * 12):
    rng = random.Random(seed)
    base = datetime(2024, 1, 1)
    return [(i, base + timedelta(microseconds=rng.randrange(hours * 3_600_000_000)), rng.choice(users))
            for i in range(n)]


def brute_sessions(data, gap_hours=8):
    """{event_id: (user, session number, position)} by walking each user's events in order."""
    out = {}
    last, number, pos = {}, {}, {}
    for event_id, ts, user in sorted(data, key=lambda r: (r[2], r[1], r[0])):
        if user not in last or ts - last[user] > timedelta(hours=gap_hours):
            number[user] = number.get(user, 0) + 1
            pos[user] = 0
        last[user] = ts
        pos[user] += 1
        out[event_id] = (user, number[user], pos[user])
    return out


# A third of all events belong to user 0; others are sparse.
HOT = raw_events(600, [0] * 12 + list(range(1, 25)), seed=3)


def test_sessionize_equals_a_walk_over_sorted_events(spark):
    df = spark.createDataFrame(HOT, RAW)
    mine = {r["event_id"]: (r["user_id"], r["session_no"]) for r in sessionize(df, "user_id", "ts", 8).collect()}
    assert mine == {e: v[:2] for e, v in brute_sessions(HOT).items()}


def test_openers_are_the_first_events_of_each_session(spark):
    df = spark.createDataFrame(HOT, RAW)
    got = session_openers(df, "user_id", "ts", "event_id", 8, 3)
    mine = {r["event_id"]: (r["user_id"], r["session_no"], r["pos"]) for r in got.collect()}
    assert mine == {e: v for e, v in brute_sessions(HOT).items() if v[2] <= 3}


@pytest.mark.parametrize("micros,sessions", [(0, 1), (1, 2)])
def test_exactly_the_gap_keeps_the_session(spark, micros, sessions):
    first = datetime(2024, 1, 1, 3)
    data = [(1, first, 7), (2, first + timedelta(hours=8, microseconds=micros), 7)]
    got = sessionize(spark.createDataFrame(data, RAW), "user_id", "ts", 8)
    assert max(r["session_no"] for r in got.collect()) == sessions


def test_equal_times_are_ordered_by_event_id(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(5, at, 1), (3, at, 1), (4, at, 1)], RAW)
    got = session_openers(df, "user_id", "ts", "event_id", 8, 6)
    assert [(r["event_id"], r["pos"]) for r in got.orderBy("pos").collect()] == [(3, 1), (4, 2), (5, 3)]


def test_events_without_user_or_time_are_kept_outside_sessions(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, at, 1), (2, at, None), (3, None, 1), (4, at + timedelta(hours=9), 1)], RAW)
    got = {r["event_id"]: r["session_no"] for r in sessionize(df, "user_id", "ts", 8).collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 2}
    assert session_openers(df, "user_id", "ts", "event_id", 8, 6).count() == 2


def test_times_before_1970(spark):
    first = datetime(1969, 12, 31, 20)
    data = [(i, first + timedelta(hours=3 * i), 1) for i in range(6)]
    assert {r["session_no"] for r in sessionize(spark.createDataFrame(data, RAW), "user_id", "ts", 8).collect()} == {1}


def test_no_window_orders_raw_events_per_user(spark):
    text = plan(funnel_events(typed_events(spark)))
    # No event is ranked: the only per-user window is over slices.
    assert "row_number" not in text and "WindowGroupLimit" not in text
    assert "Partial" in text or "partial" in text


def test_seconds_are_counted_by_boundaries(spark, made):
    made.add("s1", "view_homepage", 0.9).add("s1", "search_product", 1.1)
    assert rows(ses.int_sessions(made.df(spark)))[0]["session_duration"] == 1


def test_session_columns(spark, made):
    made.add("s1", "view_homepage", 0).add("s1", "view_homepage", 5).add("s1", "checkout_initiated", 60)
    made.add("s2", "search_product", 86_400 * 2, event_id=None)
    made.add("s3", None, 10, signup_date=None)
    one, two, three = rows(ses.int_sessions(made.df(spark)), "session_id")
    assert (one["user_type"], one["session_duration"], one["total_events"], one["homepage_views"]) == ("new_user", 60, 3, 2)
    assert one["has_checkout"] is True and one["has_purchased"] is False
    assert two["user_type"] == "returning_user" and two["total_events"] == 0
    # No sign-up date counts as returning; no event type is false, not NULL.
    assert three["user_type"] == "returning_user" and three["has_checkout"] is False


def test_conflicting_channel_takes_the_greatest(spark, made):
    made.add("s1", "view_homepage", 0, acquisition_channel="Direct")
    made.add("s1", "search_product", 1, acquisition_channel="Organic")
    assert rows(ses.int_sessions(made.df(spark)))[0]["acquisition_channel"] == "Organic"


def test_gaps_use_first_times_and_may_be_negative(spark, made):
    made.add("s1", "search_product", 10).add("s1", "view_homepage", 30).add("s1", "search_product", 50)
    stg = made.df(spark)
    row = rows(ses.int_step_transition(stg, ses.int_sessions(stg)))[0]
    assert row["homepage_to_search_seconds"] == -20
    assert row["search_to_product_view_seconds"] is None
    assert row["session_end"] == START + timedelta(seconds=50)


def test_shared_session_id_fans_out_in_the_general_form(spark, made):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 20, user_id="u2")
    stg = made.df(spark)
    got = rows(ses.int_step_transition(stg, ses.int_sessions(stg)), "user_id")
    assert [(r["user_id"], r["homepage_to_search_seconds"]) for r in got] == [("u1", 20), ("u2", 20)]


def test_one_aggregate_equals_the_join_when_ids_are_unique(spark):
    stg = funnel_events(typed_events(spark))
    joined = ses.int_step_transition(stg, ses.int_sessions(stg))
    fused = ses.transitions_from_facts(ses.session_facts(stg))
    assert sorted(map(str, joined.collect())) == sorted(map(str, fused.collect()))


def test_null_session_id_never_joins(spark, made):
    made.add(None, "view_homepage", 0).add("s1", "view_homepage", 0)
    stg = made.df(spark)
    assert ses.int_step_transition(stg, ses.int_sessions(stg)).count() == 1
    assert ses.transitions_from_facts(ses.session_facts(stg)).count() == 1


def test_partials_of_split_sessions_merge_to_the_whole(spark):
    stg = funnel_events(typed_events(spark))
    whole = ses.session_facts(stg)
    odd, even = stg.where("int(event_id) % 2 = 1"), stg.where("int(event_id) % 2 = 0")
    parts = ses.session_partials(odd, step_times=True).unionByName(ses.session_partials(even, step_times=True))
    merged = ses.finish_sessions(ses.merge_partials(parts))
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))


def test_first_session_per_user(spark, made):
    made.add("s2", "view_homepage", 0, device="tablet").add("s1", "view_homepage", 0, device="mobile")
    made.add("s0", "view_homepage", 99, device="desktop")
    got = rows(ses.first_session_per_user(ses.int_sessions(made.df(spark)), ["device"]))
    assert got == [{"user_id": "u1", "device": "mobile"}]


def test_a_hot_slice_is_split_across_tasks(spark):
    """A third of all events in one user's one slice: the join splits that partition."""
    base = datetime(2024, 1, 1)
    data = [(i, base + timedelta(seconds=i % 20_000), 0) for i in range(20_000)]
    data += [(20_000 + i, base + timedelta(hours=i % 700), 1 + i % 997) for i in range(40_000)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = sessionize(spark.createDataFrame(data, RAW).repartition(12), "user_id", "ts", 8)
        assert len(got.collect()) == len(data)
        assert "skew=true" in plan(got)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_event_is_dropped_and_steps_repeat(spark):
    stg = funnel_events(typed_events(spark))
    assert stg.count() == len(HOT)
    assert stg.groupBy("session_id", "event_type").count().where("count > 1").count() > 0
