from collections import Counter

import pytest

from conftest import Events, rows
from paceline.operators import marts, quality, sessions as ses

SESSION = ("session_id string, homepage_views long, has_searched_product long, has_viewed_product long, "
           "added_to_cart long, has_checkout boolean, has_purchased boolean")


def test_declared_rules_per_table():
    count = Counter(r.model for r in quality.declared_rules())
    assert count == {"stg_events": 15, "int_sessions": 21, "int_step_transition": 13, "fct_conversion_funnel": 11,
                     "fct_ab_test_summary": 8, "fct_user_retention": 6, "fct_ab_transitions": 9,
                     "fct_session_dropoff": 5}
    assert sum(count.values()) == 88 and len(set(quality.declared_rules())) == 88


def test_row_level_forms(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 3), ("zz", None)], "k string, n int")
    assert quality.not_null(df, ["k", "n"]).count() == 3
    assert quality.accepted_values(df, "k", ["a"]).count() == 1
    assert quality.accepted_values(df, "k", ["zz"], "n < 2").count() == 1
    assert [r["k"] for r in rows(quality.unique(df, "k"))] == ["a"]
    assert rows(quality.unique_combination(df, ["k", "n"])) == [{"k": None, "n": 3, "copies": 2}]


def test_booleans_are_tested_as_zero_or_one(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert quality.accepted_values(df, "b", [0, 1]).count() == 0
    assert quality.accepted_values(df, "b", [0]).count() == 1


@pytest.mark.parametrize("counts,loose,strict", [
    ((1, 1, 1, 1, True, True), 0, 0),
    ((1, 1, 1, 1, False, True), 1, 1),
    ((1, 1, 1, 0, True, False), 1, 1),
    ((1, 1, 0, 2, False, False), 0, 1),   # seen twice: only the strict form looks
    ((0, 1, 1, 1, True, True), 0, 1),     # search without homepage
    ((0, 0, 0, 0, False, False), 1, 0),   # neither first nor second step
])
def test_funnel_monotonicity(spark, counts, loose, strict):
    df = spark.createDataFrame([("s", *counts)], SESSION)
    assert quality.funnel_monotonicity(df).count() == loose
    assert quality.funnel_monotonicity(df, strict=True).count() == strict


def test_negative_transitions(spark, made):
    made.add("s1", "search_product", 0).add("s1", "view_homepage", 9).add("s2", "view_homepage", 0)
    stg = made.df(spark)
    bad = quality.no_negative_transitions(ses.int_step_transition(stg, ses.int_sessions(stg)))
    assert [r["session_id"] for r in rows(bad)] == ["s1"]


def test_dropoff_assertions(spark):
    schema = "device string, variant string, acquisition_channel string, exit_event string, total_exits long, exit_percentage double"
    df = spark.createDataFrame([
        ("d", "v", "Email", "a", 10, 100.0), ("d", "w", "Email", "a", 9, 100.0),
        ("d", "x", "Email", "a", 50, 60.0), ("d", "y", None, "a", 50, 100.0)], schema)
    assert [(r["variant"], r["total_segment_pct"]) for r in rows(quality.dropoff_percentage_sum(df))] == [("x", 60.0)]
    assert [r["variant"] for r in rows(quality.no_full_exit_segment(df))] == ["v"]


def test_retention_bounds(spark):
    schema = ("cohort_size long, newest_users long, first_week_users long, second_week_users long, month_users long, "
              "d1_retention_rate double, d7_retention_rate double, d14_retention_rate double")
    df = spark.createDataFrame([
        (5, 5, 5, 5, 5, 100.0, 100.0, 100.0), (5, 6, 0, 0, 0, 0.0, 0.0, 0.0), (5, 0, 0, 0, 0, -1.0, 0.0, 0.0),
        (5, 0, 0, 0, 0, None, 100.5, 0.0), (0, 0, 0, 0, 0, None, None, None)], schema)
    assert quality.retention_bounds(df).count() == 3


def test_event_order(spark, made):
    made.add("ok", "view_homepage", 0).add("ok", "search_product", 0).add("ok", "add_to_cart", 4)
    made.add("swap", "search_product", 0).add("swap", "view_homepage", 1)
    made.add("skip", "view_homepage", 9).add("skip", "purchase_completed", 3)
    assert [r["session_id"] for r in rows(quality.event_order(made.df(spark)), "session_id")] == ["skip", "swap"]


def test_changing_attributes(spark, made):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 1, device="tablet")
    made.add("s2", "view_homepage", 0, user_id="u2").add("s2", "view_homepage", 0, user_id="u2", device=None)
    got = rows(quality.changing_attributes(made.df(spark), ["device", "variant"]))
    assert got == [{"user_id": "u1", "device_changes": True, "variant_changes": False}]


def test_suite_counts_every_violation_with_one_scan_per_table(spark, made):
    made.add("s1", "view_homepage", 0, event_id="a").add("s1", "bogus", 1, event_id="a", device="fridge")
    made.add("s2", "view_homepage", 0, user_id=None, variant=None)
    stg = made.df(spark)
    sessions = ses.int_sessions(stg)
    tables = {"stg_events": stg, "int_sessions": sessions, "fct_session_dropoff": marts.session_dropoff(stg)}
    got = {(r["model"], r["test"], r["column"]): r["failures"] for r in rows(quality.run_suite(tables))}
    assert len(got) == 15 + 21 + 5 + 3
    assert got["stg_events", "unique", "event_id"] == 1
    assert got["stg_events", "not_null", "user_id"] == 1 and got["stg_events", "not_null", "variant"] == 1
    assert got["stg_events", "accepted_values", "variant"] == 0  # NULL is not a bad value
    assert got["stg_events", "accepted_values", "event_type"] == 1
    assert got["stg_events", "accepted_values", "device"] == 1
    assert got["int_sessions", "unique", "session_id"] == 1  # s1 has two devices
    assert got["fct_session_dropoff", "accepted_values", "exit_event"] == 1
    assert got["fct_session_dropoff", "dropoff_percentage_sum", "*"] == 0


def test_counts_of_the_write_equal_those_of_a_scan(spark, made, tmp_path):
    """Over good, odd, empty and nameless events, with session ids of one user and of several."""
    from paceline.plans.build import build_tables

    for n, shared in enumerate((False, True, None)):
        events = Events()
        if shared is not None:
            for i in range(30):
                step = ["view_homepage", "search_product", "odd", "purchase_completed", None][i % 5]
                events.add(None if i % 11 == 0 else f"s{i % 7}", step, (i * 37) % 100, user_id=f"u{i % 3 if shared else 0}",
                           device=None if i % 6 == 0 else "watch" if shared else "mobile", event_id=f"e{i // 2}")
        watched = quality.Watched()
        tables = build_tables(events.df(spark), str(tmp_path / str(n)), watched=watched)
        assert set(watched.found) == set(tables)
        key = ("model", "test", "column")
        seen, scanned = rows(quality.run_suite(tables, watched=watched), *key), rows(quality.run_suite(tables), *key)
        assert len(seen) == 93 and seen == scanned
        assert sum(r["failures"] > 0 for r in seen) >= (0 if shared is None else 5)
