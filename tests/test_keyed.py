"""Keyed tables, dedup without a horizon, sessions by key, cohorts by delta, and publication."""

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import START, Events, rows
from paceline.operators import marts, sessions as ses
from paceline.operators.staging import dedup_events
from paceline.plans import publish
from paceline.plans.build import DataTestFailure
from paceline.streaming import dedup, ingest, keyed, retention, sessions as ssessions


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def summed(df):
    return df.groupBy("k").agg(F.sum("v").alias("v"))


def batch_of(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v long")


def test_pointer_keeps_the_last_two_versions(spark, tmp_path):
    pointer = keyed.Pointer(spark, str(tmp_path / "p"), "name string")
    assert pointer.versions() == []
    for n in range(5):
        assert pointer.put([(f"v{n}",), ("x",)]) == n
        assert [(v, sorted(r["name"] for r in got)) for v, got in pointer.versions()] == [
            (v, sorted([f"v{v}", "x"])) for v in range(n, max(-1, n - 2), -1)]


def test_keyed_table_equals_one_big_merge(spark, tmp_path):
    rng = random.Random(4)
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], summed, buckets=4, max_parts=3)
    assert table.read() is None
    total, files = {}, []
    for n in range(9):
        pairs = [(rng.choice([None, *"abcdefghij"]), rng.randrange(100)) for _ in range(rng.randrange(1, 8))]
        for k, v in pairs:
            total[k] = total.get(k, 0) + v
        table.apply(n, batch_of(spark, pairs))
        table.apply(n, batch_of(spark, [("a", 10**6)]))  # a batch that is run again counts once
        files.append(max(len(p) for p in table.state().parts.values()))
        assert {r["k"]: r["v"] for r in table.read().collect()} == total
    assert max(files) < 3 and any(p.startswith("fold-") for parts in table.state().parts.values() for p in parts)
    assert table.state(before=8).batch == 7 and table.state().batch == 8


def test_a_killed_batch_leaves_the_old_manifest(spark, tmp_path, monkeypatch):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], summed, buckets=2, max_parts=2)
    table.apply(0, batch_of(spark, [("a", 1), ("b", 2)]))
    before = rows(table.read(), "k")

    def killed(*_):
        raise RuntimeError("killed")

    for stage in ("put", "with_part"):
        with monkeypatch.context() as m:
            if stage == "put":
                m.setattr(table.manifest, "put", killed)
            with pytest.raises(RuntimeError):
                table.apply(1, batch_of(spark, [("a", 10), ("c", 3)]), killed if stage == "with_part" else None)
        assert rows(table.read(), "k") == before
    table.apply(1, batch_of(spark, [("a", 10), ("c", 3)]))
    assert {r["k"]: r["v"] for r in table.read().collect()} == {"a": 11, "b": 2, "c": 3}
    table.apply(2, batch_of(spark, []))
    assert table.state().batch == 2 and table.read().count() == 3


def test_bloom_filters_hold_what_they_were_built_from():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 20_000, dtype=np.int64).view(np.uint64)
    held = dedup.bloom(h[:10_000])
    assert dedup.may_hold(held, h[:10_000]).all() and dedup.may_hold(held, h[10_000:]).mean() < 0.03
    assert len(held) == 12_500 and not dedup.may_hold(dedup.bloom(h[:0]), h).any()


def events_with_copies(n, seed=7):
    rng, made = random.Random(seed), Events()
    for i in range(n):
        made.add(f"s{i % 9}", "view_homepage", i, event_id=f"id{i}")
    base = list(made.rows)
    copies = [tuple(START + timedelta(days=rng.randrange(40)) if c == START else c for c in r) for r in base for _ in range(rng.randrange(3))]
    nameless = [(None, *r[1:]) for r in base[:3]]
    return base, copies, nameless


def test_dedup_without_horizon_equals_batch(spark, tmp_path):
    from conftest import STAGED
    base, copies, nameless = events_with_copies(60)
    every = [*base, *copies, *nameless, *nameless]
    random.Random(2).shuffle(every)
    source, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    for k in range(0, len(every), 25):  # a file a batch
        spark.createDataFrame(every[k:k + 25], STAGED).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    ran = ingest.drain(dedup.dedup_for_good(stream, out, state, every=None, buckets=3, max_parts=3))
    assert ran["batches"] > 4
    want = dedup_events(spark.createDataFrame(every, STAGED))
    got = dedup.deduplicated(spark, out)
    assert same(got.drop("ingested_at"), want.drop("ingested_at")) and got.count() == 66
    parts = dedup.SeenIds(spark, f"{out}/ids", "event_id", buckets=3, max_parts=3).table.state().parts
    assert max(map(len, parts.values())) < 3
    late = spark.createDataFrame([(*r[:-1], START + timedelta(days=400)) for r in base[:5]], STAGED)
    late.write.mode("append").parquet(source)
    ingest.drain(dedup.dedup_for_good(stream, out, state, every=None, buckets=3, max_parts=3))
    assert dedup.deduplicated(spark, out).count() == 66


def test_a_dedup_batch_run_again_writes_the_same_rows(spark, tmp_path):
    from conftest import STAGED
    base, _, _ = events_with_copies(20)
    table = spark.createDataFrame(base, STAGED)
    seen = dedup.SeenIds(spark, str(tmp_path / "ids"), "event_id", buckets=2)
    first, second = table.limit(12), table
    assert seen.unseen(first, 0).count() == 12
    seen.add(0, first)
    assert seen.unseen(second, 1).count() == 8
    seen.add(1, seen.unseen(second, 1))
    assert seen.unseen(second, 1).count() == 8 and seen.unseen(second, 2).count() == 0


def shuffled_sessions(seed, n=150):
    rng, made = random.Random(seed), Events()
    steps = ["view_homepage", "search_product", "add_to_cart", "purchase_completed"]
    for i in range(n):
        u = rng.randrange(12)
        made.add(f"s{u}_{rng.randrange(5)}", rng.choice(steps), rng.randrange(35 * 86400), user_id=None if u == 11 else f"u{u}",
                 variant="control" if u % 2 else "new_checkout_ui", acquisition_channel=None if u == 10 else "Email",
                 signup_date=START.date() - timedelta(days=u), device="mobile" if u % 3 else None)
    rng.shuffle(made.rows)
    return made


def test_sessions_by_key_equal_batch(spark, tmp_path):
    made = shuffled_sessions(3)
    table = ssessions.session_table(spark, str(tmp_path / "t"), buckets=4, max_parts=3)
    assert ssessions.kept_sessions(spark, str(tmp_path / "t")) is None
    whole = made.df(spark)
    for n, k in enumerate(range(0, 150, 30)):
        made.rows = whole.collect()[k:k + 30]
        table.apply(n, ses.session_partials(made.df(spark), step_times=True))
    assert same(ssessions.kept_sessions(spark, str(tmp_path / "t")), ses.session_facts(whole))


def test_cohorts_by_delta_equal_batch_with_late_events(spark, tmp_path):
    made = shuffled_sessions(5)
    every = list(made.rows)
    table = retention.RetentionTable(spark, str(tmp_path / "t"), buckets=3, max_parts=3)
    assert table.read() is None
    for n, k in enumerate(range(0, 150, 30)):
        made.rows = every[k:k + 30]
        table.apply(n, made.df(spark))
        if n == 2:  # killed between the two tables, then run again
            table.days.apply(n, made.df(spark))
            table.apply(n, made.df(spark))
        made.rows = every[:k + 30]
        assert same(table.read(), marts.user_retention(ses.int_sessions(made.df(spark)))), n
    assert table.days.read().where("sessions < 0").count() == 0
    assert table.days.read().where("sessions = 0").count() > 0  # days that late events took back


def test_readers_see_one_version_of_all_tables(spark, tmp_path):
    made = Events()
    for i in range(6):
        made.add(f"s{i}", "view_homepage", i * 60, user_id=f"u{i}").add(f"s{i}", "search_product", i * 60 + 5, user_id=f"u{i}")
    path = str(tmp_path / "pub")
    assert publish.Publication(spark, path).tables() == {}
    good = made.df(spark)
    publish.publish_tables(spark, good, path, fail_on_violation=False)
    first = {n: rows(df) for n, df in publish.Publication(spark, path).tables().items()}
    assert {"stg_events", "int_sessions", "int_step_transition", "fct_user_retention", "data_tests", "srm_check"} <= first.keys()
    assert len(first["stg_events"]) == 12 and len(first["int_sessions"]) == 6
    damaged = good.unionByName(good)  # every id twice
    with pytest.raises(DataTestFailure):
        publish.publish_tables(spark, damaged, path)
    again = publish.Publication(spark, path)
    assert {n: sorted(map(str, rows(df))) for n, df in again.tables().items()} == {n: sorted(map(str, r)) for n, r in first.items()}
    publish.publish_tables(spark, good.limit(4), path, fail_on_violation=False)
    assert again.tables()["stg_events"].count() == 4
    assert len(again.drop_old_versions()) == 1 and again.tables()["stg_events"].count() == 4
