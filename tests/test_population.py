import math

import pytest

from conftest import rows
from paceline.operators import population as pop, sessions as ses
from paceline.sources import landing as land
from test_marts import funnel_events


def counts(spark, n1, n2, m):
    return rows(pop.chapman_from_counts(spark.createDataFrame([(n1, n2, m)], "n1 long, n2 long, overlap long")))[0]


def test_chapman_formula(spark):
    got = counts(spark, 50, 40, 10)
    assert got["estimated_users"] == pytest.approx(51 * 41 / 11 - 1, abs=1e-4)
    se = math.sqrt(51 * 41 * 40 * 30 / (121 * 12))
    assert got["std_err"] == pytest.approx(se, abs=1e-4)
    assert got["ci_high"] - got["ci_low"] == pytest.approx(2 * 1.96 * se, abs=1e-3)


def test_no_overlap_has_no_spread(spark):
    got = counts(spark, 5, 4, 0)
    assert got["estimated_users"] == 29.0 and math.isnan(got["std_err"]) and math.isnan(got["ci_low"])


def test_captures_are_disjoint_bounded_and_at_most_half(spark):
    units = spark.createDataFrame([(f"h{i % 11}",) for i in range(100)] + [(None,)], "unit string")
    for cap, half in ((3, 3), (100, 5)):
        got = rows(pop.captures(units, "unit", cap))
        assert sorted(r["capture"] for r in got) == [1] * half + [2] * half
        assert len({r["unit"] for r in got}) == 2 * half


def test_one_unit_cannot_be_split(spark):
    df = spark.createDataFrame([("only", "u1")], "unit string, user_id string")
    got = rows(pop.chapman_estimate(df, "unit", "user_id"))[0]
    assert (got["n1"], got["n2"], got["estimated_users"]) == (0, 0, 0.0)


def test_estimate_over_landed_files(spark, made, tmp_path):
    for i in range(60):
        made.add(f"s{i}", "view_homepage", 86_400 * (i % 12), user_id=f"u{i % 20}")
    out = str(tmp_path / "landing")
    land.write_ndjson(land.payload(made.df(spark)), out)
    assert land.list_files(spark, out).count() == 12
    got = rows(pop.chapman_from_files(spark, out))[0]
    assert 0 < got["n1"] <= 20 and 0 < got["n2"] <= 20 and got["overlap"] <= min(got["n1"], got["n2"])
    few = rows(pop.chapman_from_files(spark, out, capture_units=1))[0]
    assert (few["n1"], few["n2"]) == (5, 5)


def test_estimate_over_date_folders_equals_the_one_over_dates(spark, made, tmp_path):
    for i in range(60):
        made.add(f"s{i}", "view_homepage", 86_400 * (i % 12), user_id=f"u{i % 30}")
    stg = made.df(spark)
    out = str(tmp_path / "landing")
    land.write_ndjson(land.payload(stg), out)
    dates = stg.selectExpr("date_format(event_timestamp, \"'year='yyyy'/month='MM'/day='dd\") AS day", "user_id")
    for cap in (2, 100):
        got, expected = pop.chapman_from_folders(spark, out, cap), pop.chapman_estimate(dates, "day", "user_id", cap)
        assert str(rows(got)) == str(rows(expected))  # NaN without overlap


def test_power_reach_and_sessions_per_user(spark, made):
    funnel_events(made, [6, 5, 5, 5, 4, 2, 1])
    funnel_events(made, [1], user_id="u2")
    sessions = ses.int_sessions(made.df(spark))
    plan = rows(pop.power_plan(sessions, ["device"]))[0]
    assert (plan["checkouts"], plan["purchases"], plan["baseline_rate"]) == (4, 1, 0.25)
    assert plan["n_total"] == 2 * plan["n_per_arm"]
    reach = rows(pop.funnel_reach(sessions, ["variant"]), "step_no")
    assert [r["to_step"] for r in reach] == ["search_product", "view_product_details", "add_to_cart", "checkout_initiated"]
    assert [(r["from_sessions"], r["to_sessions"]) for r in reach] == [(8, 6), (6, 5), (5, 5), (5, 4)]
    assert reach[-1]["reach"] == 0.5
    spread = rows(pop.sessions_per_user(sessions), "sessions")
    assert spread == [{"sessions": 1, "users": 1, "share": 0.5, "mean_sessions": 4.0},
                      {"sessions": 7, "users": 1, "share": 0.5, "mean_sessions": 4.0}]


def test_reach_is_zero_past_a_dead_step(spark, made):
    funnel_events(made, [2, 1])
    got = rows(pop.funnel_reach(ses.int_sessions(made.df(spark)), ["variant"]), "step_no")
    assert [(r["step_rate"], r["reach"]) for r in got] == [(0.5, 0.5), (0.0, 0.0), (None, 0.0), (None, 0.0)]


@pytest.mark.parametrize("found,verdict", [(1e9, "ENOUGH"), (10.0, "NOT ENOUGH")])
def test_verdict(spark, made, found, verdict):
    funnel_events(made, [5, 1])
    estimate = spark.createDataFrame([(found, 0.0, 2.0)], "estimated_users double, ci_low double, ci_high double")
    got = rows(pop.population_verdict(ses.int_sessions(made.df(spark)), estimate))[0]
    assert (got["n_per_arm"], got["sessions_per_user"], got["checkout_reach"]) == (31_234, 2.0, 0.5)
    assert got["required_users"] == 62_468.0 and got["verdict"] == verdict
