import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest

from conftest import START, plan, rows
from paceline.operators import marts, sessions as ses
from paceline.spec import FunnelSpec, Rate, Step

STEPS = ["view_homepage", "search_product", "view_product_details", "add_to_cart",
         "checkout_initiated", "purchase_completed"]


def funnel_events(made, depths, **over):
    for i, depth in enumerate(depths):
        for j, step in enumerate(STEPS[:depth]):
            made.add(f"{over.get('user_id', 'u1')}-s{i}", step, 1000 * i + 10 * j, **over)
    return made


def test_funnel_counts_and_rates(spark, made):
    funnel_events(made, [1, 2, 4, 6])
    got = rows(marts.conversion_funnel(ses.int_sessions(made.df(spark))))[0]
    assert (got["total_sessions"], got["unique_users"]) == (4, 1)
    assert [got[c] for c in ("sessions_with_homepage_view", "sessions_with_cart_adds", "sessions_with_purchase")] == [4, 2, 1]
    assert (got["homepage_to_product_rate"], got["product_to_cart_rate"], got["cart_to_checkout_rate"]) == (50.0, 100.0, 50.0)
    assert (got["cart_abandonment_rate"], got["checkout_abandonment_rate"]) == (50.0, 0.0)
    assert got["overall_conversion_rate"] == 25.0 and got["avg_session_duration"] == 22.5


def test_zero_denominators_are_null(spark, made):
    made.add("s1", "search_product", 0)
    got = rows(marts.conversion_funnel(ses.int_sessions(made.df(spark))))[0]
    assert got["homepage_to_product_rate"] is None and got["cart_abandonment_rate"] is None
    assert got["overall_conversion_rate"] == 0.0


def test_repeated_views_leave_the_summary_but_not_the_funnel(spark, made):
    made.add("s1", "view_homepage", 0).add("s1", "view_homepage", 5)
    sessions = ses.int_sessions(made.df(spark))
    assert rows(marts.conversion_funnel(sessions))[0]["sessions_with_homepage_view"] == 1
    assert rows(marts.ab_test_summary(sessions))[0]["sessions_homepage"] == 0


def test_summary_rates_are_fractions(spark, made):
    funnel_events(made, [6, 5, 1])
    got = rows(marts.ab_test_summary(ses.int_sessions(made.df(spark))))[0]
    assert (got["overall_conversion_rate"], got["checkout_to_purchase_rate"]) == (0.3333, 0.5)


def test_both_counting_forms_agree_and_differ_on_shared_sessions(spark, made):
    funnel_events(made, [1, 3, 6])
    funnel_events(made, [2, 2], user_id="u2")
    funnel_events(made, [4], user_id=None)
    sessions = ses.int_sessions(made.df(spark))
    for fn in (marts.conversion_funnel, marts.ab_test_summary):
        assert rows(fn(sessions)) == rows(fn(sessions, one_row_per_session=True))
    made.add("u2-s0", "view_homepage", 5, user_id="u1")
    shared = ses.int_sessions(made.df(spark))
    exact = rows(marts.ab_test_summary(shared))[0]
    assert exact["total_sessions"] == 6 and exact["total_users"] == 2


def test_dropoff_exit_bounce_and_share(spark, made):
    funnel_events(made, [1, 1, 3])
    funnel_events(made, [2], user_id="u2", acquisition_channel="Direct")
    got = rows(marts.session_dropoff(made.df(spark)), "acquisition_channel", "exit_event")
    assert [(r["acquisition_channel"], r["exit_event"], r["total_exits"], r["bounced_sessions"], r["exit_percentage"])
            for r in got] == [("Direct", "search_product", 1, 0, 25.0),
                              ("Email", "view_homepage", 2, 2, 50.0),
                              ("Email", "view_product_details", 1, 0, 25.0)]


def test_last_event_ties_and_mixed_attributes(spark, made):
    made.add("s1", "view_homepage", 5, event_id="b", device="mobile")
    made.add("s1", "search_product", 5, event_id="c", device="tablet")
    made.add("s1", "add_to_cart", 5, event_id="a", device="desktop")
    made.add("s1", "add_to_cart", 0, event_id="z", event_timestamp=None)
    got = rows(marts.session_dropoff(made.df(spark)))
    assert [(r["device"], r["exit_event"], r["bounced_sessions"]) for r in got] == [("tablet", "search_product", 0)]


def test_events_without_session_are_one_group_and_no_exit(spark, made):
    made.add(None, "view_homepage", 0).add(None, "search_product", 9).add("s1", "view_homepage", 0)
    got = rows(marts.session_dropoff(made.df(spark)), "exit_event")
    assert [(r["exit_event"], r["total_exits"]) for r in got] == [("search_product", 0), ("view_homepage", 1)]


ACTIVITY = "user_id string, variant string, acquisition_channel string, user_signup_date date, session_start timestamp_ntz"


def literal_retention(data):
    """Cohorts joined with activity, as the definition reads."""
    days = {}
    for user, variant, channel, signup, start in data:
        key = (user, variant, channel, start.date())
        days[key] = max(days[key], signup) if days.get(key) and signup else days.get(key) or signup
    cohorts = defaultdict(set)
    for (user, variant, channel, _), signup in days.items():
        cohorts[(signup, variant, channel)].add(user)
    out = {}
    for cohort, users in cohorts.items():
        def active(low, high):
            if None in cohort:
                return 0
            return len({u for (u, v, c, day), s in days.items() if (s, v, c) == cohort and u is not None
                        and low <= (day - s).days <= high})
        size = len(users - {None})
        out[cohort] = (size, active(0, 0), active(6, 8), active(13, 15), active(28, 30),
                       *[round(100 * active(*w) / size, 2) if size else None for w in ((1, 1), (6, 8), (13, 15))])
    return out


def test_retention_equals_the_literal_join(spark):
    rng = random.Random(5)
    data = []
    for u in range(40):
        signup = date(2024, 5, 1) + timedelta(days=rng.randrange(3))
        arm, channel = rng.choice(["a", "b"]), rng.choice(["Email", "Direct", None])
        for _ in range(rng.randrange(1, 9)):
            data.append((f"u{u}", arm, channel, signup,
                         datetime(2024, 5, 1, 12) + timedelta(days=rng.randrange(-2, 33), hours=rng.randrange(9))))
    data.append((None, "a", "Email", date(2024, 5, 1), datetime(2024, 5, 1)))
    data.append(("u1", "a", "Email", None, datetime(2024, 5, 1)))
    # One user with two sign-up dates belongs to two cohorts.
    data += [("twice", "a", "Email", date(2024, 5, 1), datetime(2024, 5, 8)),
             ("twice", "a", "Email", date(2024, 5, 2), datetime(2024, 5, 9))]
    got = {(r["cohort_date"], r["variant"], r["acquisition_channel"]): tuple(r[c] for c in (
        "cohort_size", "newest_users", "first_week_users", "second_week_users", "month_users",
        "d1_retention_rate", "d7_retention_rate", "d14_retention_rate"))
        for r in rows(marts.user_retention(spark.createDataFrame(data, ACTIVITY)))}
    assert got == literal_retention(data)


def test_immature_rates_can_be_blanked(spark):
    data = [("u1", "a", "Email", date(2024, 5, 1), datetime(2024, 5, 1)),
            ("u1", "a", "Email", date(2024, 5, 1), datetime(2024, 5, 10))]
    df = spark.createDataFrame(data, ACTIVITY)
    assert rows(marts.user_retention(df))[0]["d14_retention_rate"] == 0.0
    blanked = rows(marts.user_retention(df, mature_only=True))[0]
    assert blanked["d14_retention_rate"] is None and blanked["d7_retention_rate"] == 0.0


def test_grouping_sets_forms_agree(spark, made):
    funnel_events(made, [1, 3, 6])
    funnel_events(made, [5, 2], user_id="u2", device="tablet", variant="new_checkout_ui")
    made.add("x", "view_homepage", 0, device=None)
    stg = made.df(spark)
    transitions = ses.int_step_transition(stg, ses.int_sessions(stg))
    a = rows(marts.ab_transitions(transitions), "variant", "grain", "device")
    assert a == rows(marts.ab_transitions(transitions, one_row_per_session=True), "variant", "grain", "device")
    top = [r for r in a if r["grain"] == "variant_level" and r["variant"] == "control"][0]
    assert top["device"] is None and top["total_sessions"] == 4
    # A missing device is a segment of its own, not the rollup row.
    assert any(r["device"] is None and r["grain"] == "segment_level" for r in a)


def test_empty_input_gives_empty_tables(spark, made):
    stg = made.add("s", "view_homepage", 0).df(spark).where("false")
    sessions = ses.int_sessions(stg)
    for df in (marts.conversion_funnel(sessions), marts.ab_test_summary(sessions), marts.session_dropoff(stg),
               marts.user_retention(sessions)):
        assert df.count() == 0


def test_another_funnel(spark):
    """Two steps on other column names: nothing is tied to one product."""
    spec = FunnelSpec(
        steps=(Step("open", "open", "opens", "open_ts", "n_open", "n_open"),
               Step("buy", "buy", "bought", "buy_ts", "n_buy", "n_buy", as_flag=True)),
        rates=(Rate("buy_rate", "buy", "open"),), event_id="id", event_type="kind", event_ts="at",
        session="visit", user="who", variant="arm", device="dev", channel="src", signup="joined")
    data = [("1", "open", START, "v1", "w", "a", "d", "s", START.date()),
            ("2", "buy", START + timedelta(seconds=3), "v1", "w", "a", "d", "s", START.date()),
            ("3", "open", START, "v2", "w", "a", "d", "s", START.date())]
    stg = spark.createDataFrame(data, "id string, kind string, at timestamp_ntz, visit string, who string, "
                                      "arm string, dev string, src string, joined date")
    sessions = ses.int_sessions(stg, spec)
    assert rows(marts.conversion_funnel(sessions, spec))[0]["buy_rate"] == 50.0
    steps = ses.int_step_transition(stg, sessions, spec)
    assert rows(marts.ab_transitions(steps, spec), "grain")[0]["avg_open_to_buy_seconds"] == 3.0


@pytest.mark.parametrize("name", ["fct_conversion_funnel", "fct_ab_test_summary", "fct_user_retention",
                                  "fct_session_dropoff", "fct_ab_transitions", "srm_check", "hte_main_effect",
                                  "user_features", "chapman_users", "dropoff_orders"])
def test_plans_have_no_python_and_no_cartesian_product(spark, name):
    from conftest import SMALL
    from paceline.plans.catalog import QUERIES

    text = plan(QUERIES[name](spark, SMALL))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_scans_read_only_needed_columns(spark):
    from conftest import SMALL
    from paceline.plans.catalog import QUERIES

    text = plan(QUERIES["fct_conversion_funnel"](spark, SMALL))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line]
    assert schemas and all("props" not in s and "value" not in s for s in schemas)
