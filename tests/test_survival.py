import math
import random

import pytest

from conftest import rows
from paceline.functions.stats import Z_975
from paceline.operators import sessions as ses, survival
from paceline.sources import scratch


def brute(durations, events):
    """(t, at risk, events, censored, survival, low, high) point by point."""
    out, s, v = [], 1.0, 0.0
    for t in sorted(set(durations)):
        n = sum(d >= t for d in durations)
        d = sum(e for x, e in zip(durations, events) if x == t)
        s *= 1 - d / n
        v += d / (n * (n - d)) if d < n else 0
        low = high = None
        if 0 < s < 1:
            spread = Z_975 * math.sqrt(v) / abs(math.log(s))
            center = math.log(-math.log(s))
            low, high = math.exp(-math.exp(center + spread)), math.exp(-math.exp(center - spread))
        out.append((t, n, d, durations.count(t) - d, s, low, high))
    return out


@pytest.mark.parametrize("bins", [None, 1, 7, 64])
def test_curve_equals_a_point_by_point_product(spark, bins):
    rng = random.Random(11)
    # Ties, fractions, negatives, and a value that holds a third of the rows.
    durations = [rng.choice([rng.randrange(40), round(rng.uniform(-3, 40), 6), 5]) for _ in range(400)]
    durations = [float(d) for d in durations]
    events = [rng.random() < 0.4 for _ in durations]
    df = spark.createDataFrame([("g", t, e) for t, e in zip(durations, events)]
                               + [("other", 3.0, True), (None, 1.0, True), ("g", None, True)],
                               "arm string, t double, e boolean")
    got = rows(survival.kaplan_meier(df, ["arm"], "t", "e", bins=bins))
    mine = sorted((r for r in got if r["arm"] == "g"), key=lambda r: r["t"])
    expected = brute(durations, events)
    assert len(mine) == len(expected)
    for r, (t, n, d, c, s, low, high) in zip(mine, expected):
        assert (r["t"], r["at_risk"], r["events"], r["censored"]) == (t, n, d, c)
        for name, v in (("survival", s), ("ci_low", low), ("ci_high", high)):
            assert r[name] == (None if v is None else pytest.approx(v, abs=1e-6)), (t, name)


def test_bins_follow_the_data(spark, monkeypatch):
    """Durations that differ by microseconds within a second, and a few far away: no bin is crowded."""
    kept = []
    monkeypatch.setattr(survival, "written", lambda df, label: kept.append(scratch.written(df, label)) or kept[-1])
    near = spark.range(20_000).selectExpr("'g' AS arm", "100 + id / 1e6 AS t", "id % 3 = 0 AS e")
    far = spark.range(50).selectExpr("'g' AS arm", "id * 1e6 AS t", "true AS e")
    curve = survival.kaplan_meier(near.unionAll(far), ["arm"], "t", "e", bins=20)
    sizes = [r["count"] for r in kept[0].groupBy("bin").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3 * 20_050 / 20
    got = rows(curve, "t")
    assert len(got) == 20_050 and min(r["at_risk"] for r in got) == 1 and max(r["at_risk"] for r in got) == 20_050


def test_everyone_has_the_event(spark):
    df = spark.createDataFrame([("g", 1.0, True), ("g", 2.0, True)], "arm string, t double, e boolean")
    got = rows(survival.kaplan_meier(df, ["arm"], "t", "e"), "t")
    assert [r["survival"] for r in got] == [0.5, 0.0]
    assert got[1]["ci_low"] is None and got[1]["ci_high"] is None


def test_nobody_has_the_event(spark):
    df = spark.createDataFrame([("g", 1.0, False), ("g", 2.0, False)], "arm string, t double, e boolean")
    got = rows(survival.kaplan_meier(df, ["arm"], "t", "e"), "t")
    assert [(r["survival"], r["ci_low"], r["at_risk"]) for r in got] == [(1.0, None, 2), (1.0, None, 1)]


def test_step_durations_censor_at_session_end_in_fractions(spark, made):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 10.7).add("s1", "other", 13.2)
    made.add("s2", "search_product", 0)
    stg = made.df(spark)
    transitions = ses.int_step_transition(stg, ses.int_sessions(stg))
    got = rows(survival.step_durations(transitions, keep=["session_id"]), "session_id", "transition")
    assert [(r["session_id"], r["transition"], r["duration"], r["advanced"]) for r in got] == [
        ("s1", "homepage_to_search", 10.0, True), ("s1", "search_to_product_view", 2.5, False),
        ("s2", "search_to_product_view", 0.0, False)]


def test_curves_by_variant_add_up(spark, made):
    made.add("s1", "view_homepage", 0).add("s1", "search_product", 4)
    made.add("s2", "view_homepage", 0, variant="new_checkout_ui").add("s2", "other", 9, variant="new_checkout_ui")
    stg = made.df(spark)
    transitions = ses.int_step_transition(stg, ses.int_sessions(stg))
    pooled = [r for r in rows(survival.step_curves(transitions)) if r["transition"] == "homepage_to_search"]
    split = [r for r in rows(survival.step_curves(transitions, by_variant=True)) if r["transition"] == "homepage_to_search"]
    assert sorted((r["t"], r["at_risk"]) for r in pooled) == [(4.0, 2), (9.0, 1)]
    assert sorted((r["t"], r["at_risk"]) for r in split) == [(4.0, 1), (9.0, 1)]
