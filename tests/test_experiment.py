import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, rows
from paceline.functions.stats import chi2_sf, erfc, normal_two_sided_p, sample_size
from paceline.operators import experiment as ex
from paceline.plans import catalog

SESSION = ("user_id string, session_id string, session_start timestamp_ntz, variant string, device string, "
           "acquisition_channel string, has_purchased boolean")


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("x", [0.0, 1e-6, 0.1, 0.5, 1.0, 2.0, 2.4999, 2.5, 3.0, 4.5, 6.0, 10.0])
def test_erfc(spark, x):
    assert value(spark, erfc(F.lit(x))) == pytest.approx(math.erfc(x), rel=1e-9, abs=1e-14)


@pytest.mark.parametrize("x,dof,p", [(0.1907, 1, 0.6623), (1.88, 2, 0.3906), (0.60, 3, 0.8964), (0.0, 2, 1.0),
                                     (9.488, 4, 0.05), (11.070, 5, 0.05), (18.307, 10, 0.05), (19.675, 11, 0.05)])
def test_chi2_tail(spark, x, dof, p):
    assert value(spark, chi2_sf(F.lit(x), F.lit(dof))) == pytest.approx(p, abs=6e-5)


def test_published_anchors(spark):
    srm = spark.createDataFrame([(158_586, 158_832)], "n_control long, n_treatment long")
    got = rows(ex.srm_from_counts(srm))[0]
    assert round(got["chi2"], 4) == 0.1907 and round(got["p_value"], 2) == 0.66 and got["srm_detected"] is False
    assert value(spark, sample_size(F.lit(0.05), 0.10)) == 31_234
    assert value(spark, normal_two_sided_p(F.lit(1.959963984540054))) == pytest.approx(0.05, abs=1e-9)


@pytest.mark.parametrize("p1", [0.0, 1.0, None, 0.95])
def test_sample_size_undefined_is_null(spark, p1):
    assert value(spark, sample_size(F.lit(p1).cast("double"), 0.10)) is None


def test_srm_ignores_other_arms_and_counts_each_user_once(spark):
    data = [(f"u{i}", f"s{i}-{j}", None, arm, "d", "c", False)
            for i, arm in enumerate(["control"] * 30 + ["new_checkout_ui"] * 10 + ["third"] * 9) for j in range(3)]
    got = rows(ex.srm_check(spark.createDataFrame(data, SESSION)))[0]
    assert (got["n_control"], got["n_treatment"], got["chi2"], got["srm_detected"]) == (30, 10, 10.0, True)


def test_srm_on_nothing(spark):
    got = rows(ex.srm_check(spark.createDataFrame([], SESSION)))[0]
    assert got["n_control"] == 0 and got["chi2"] is None and got["srm_detected"] is None


def test_balance_with_continuity_correction_and_empty_cells(spark):
    table = spark.createDataFrame(
        [("two", "control", "a", 10), ("two", "control", "b", 20), ("two", "t", "a", 25), ("two", "t", "b", 15),
         ("hole", "control", "a", 8), ("hole", "control", "b", 2), ("hole", "t", "b", 7), ("hole", "t", "c", 3),
         ("flat", "control", "a", 5), ("flat", "t", "a", 5)],
        "covariate string, variant string, level string, users long")
    got = {r["covariate"]: r for r in rows(ex.balance_from_table(table))}

    def by_hand(o, correct):
        o = np.array(o, dtype=float)
        e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
        gap = np.abs(o - e)
        gap = gap - np.minimum(0.5, gap) if correct else gap
        return (gap ** 2 / e).sum()

    assert got["two"]["chi2"] == pytest.approx(by_hand([[10, 20], [25, 15]], True), abs=1e-6) and got["two"]["dof"] == 1
    assert got["hole"]["chi2"] == pytest.approx(by_hand([[8, 2, 0], [0, 7, 3]], False), abs=1e-6) and got["hole"]["dof"] == 2
    assert (got["flat"]["dof"], got["flat"]["p_value"]) == (0, 1.0)


def simulated(seed, n_users=300, moving=False):
    """Sessions with a hot user, attributes fixed per user unless ``moving``."""
    rng = np.random.default_rng(seed)
    data = []
    for u in range(n_users):
        arm, device, channel = rng.choice(["control", "new_checkout_ui"]), rng.choice(["desktop", "mobile", "tablet"]), \
            rng.choice(["Direct", "Email", "Organic"])
        tilt = rng.normal(0, 0.5)
        for s in range(400 if u == 0 else rng.integers(1, 6)):
            if moving:
                arm = rng.choice(["control", "new_checkout_ui"])
            p = 1 / (1 + math.exp(-(-0.8 + 0.3 * (arm != "control") + 0.4 * (device == "mobile") + tilt)))
            data.append((f"u{u}", f"s{u}-{s}", None, str(arm), str(device), str(channel), bool(rng.random() < p)))
    return data


def direct_fit(data, covariates=True):
    """Row-level Newton and sandwich with numpy."""
    def dummies(d):
        t = float(d[3] == "new_checkout_ui")
        if not covariates:
            return [1.0, t]
        dev = [float(d[4] == v) for v in ("mobile", "tablet")]
        ch = [float(d[5] == v) for v in ("Email", "Organic")]
        return [1.0, t, *dev, *ch, *[t * v for v in dev], *[t * v for v in ch]]

    x = np.array([dummies(d) for d in data])
    y = np.array([float(d[6]) for d in data])
    users = np.unique([d[0] for d in data], return_inverse=True)[1]
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        info = (x * (p * (1 - p))[:, None]).T @ x
        b = b + np.linalg.solve(info, x.T @ (y - p))
    p = 1 / (1 + np.exp(-x @ b))
    bread = np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x)
    g = users.max() + 1
    scores = np.zeros((g, x.shape[1]))
    np.add.at(scores, users, x * (y - p)[:, None])
    n, k = x.shape
    return b, np.sqrt(np.diag(g / (g - 1) * (n - 1) / (n - k) * bread @ scores.T @ scores @ bread))


@pytest.mark.parametrize("moving", [False, True])
def test_main_effect_equals_a_row_level_fit(spark, moving):
    data = simulated(1, moving=moving)
    got = rows(ex.hte_main_effect(spark.createDataFrame(data, SESSION)))[0]
    b, se = direct_fit(data, covariates=False)
    assert (got["coef"], got["std_err"]) == (pytest.approx(b[1], abs=1e-6), pytest.approx(se[1], abs=1e-6))
    assert got["p_value"] == pytest.approx(math.erfc(abs(b[1] / se[1]) / math.sqrt(2)), abs=1e-5)
    assert (got["n_sessions"], got["n_users"]) == (len(data), 300)


@pytest.mark.parametrize("moving", [False, True])
def test_interaction_model_equals_a_row_level_fit(spark, moving):
    data = simulated(2, moving=moving)
    got = rows(ex.hte_logit(spark.createDataFrame(data, SESSION)))
    b, se = direct_fit(data)
    assert [r["term"] for r in got] == [
        "Intercept", "variant[T.new_checkout_ui]", "device[T.mobile]", "device[T.tablet]",
        "acquisition_channel[T.Email]", "acquisition_channel[T.Organic]",
        "variant[T.new_checkout_ui]:device[T.mobile]", "variant[T.new_checkout_ui]:device[T.tablet]",
        "variant[T.new_checkout_ui]:acquisition_channel[T.Email]",
        "variant[T.new_checkout_ui]:acquisition_channel[T.Organic]"]
    np.testing.assert_allclose([r["coef"] for r in got], b, atol=1e-9)
    np.testing.assert_allclose([r["std_err"] for r in got], se, atol=1e-9)


def test_interaction_model_splits_into_one_fit_per_arm(spark):
    """Every term is interacted with the arm: arm-wise fits give the same coefficients."""
    got = {r["term"]: r["coef"] for r in rows(catalog.QUERIES["hte_logit"](spark, MEDIUM))}
    assert len(got) == 12
    sessions = catalog.sessions(spark, MEDIUM).dropna(subset=["device"])  # the model leaves NULL levels out
    fits = {}
    for arm in ("control", "new_checkout_ui"):
        cells = [r.asDict() for r in sessions.where(F.col("variant") == arm).groupBy("device", "acquisition_channel")
                 .agg(F.count("*").alias("n"), F.sum(F.col("has_purchased").cast("int")).alias("y")).collect()]
        devices, channels = ["mobile", "tablet"], ["Email", "Google_Ads", "Organic"]
        x = np.array([[1.0, *[float(c["device"] == d) for d in devices],
                       *[float(c["acquisition_channel"] == d) for d in channels]] for c in cells])
        beta, _, ok = ex.fit_grouped_logit(x, np.array([float(c["n"]) for c in cells]),
                                           np.array([float(c["y"]) for c in cells]))
        assert ok
        fits[arm] = dict(zip(["Intercept", *[f"device[T.{d}]" for d in devices],
                              *[f"acquisition_channel[T.{c}]" for c in channels]], beta))
    for term, b in fits["control"].items():
        assert got[term] == pytest.approx(b, abs=1e-9)
        other = "variant[T.new_checkout_ui]" + ("" if term == "Intercept" else f":{term}")
        assert got[term] + got[other] == pytest.approx(fits["new_checkout_ui"][term], abs=1e-9)


def test_separated_data_is_reported_not_invented(spark):
    data = [d[:6] + (d[6] and d[3] == "control",) for d in simulated(3, 80)]
    df = spark.createDataFrame(data, SESSION)
    got = rows(ex.hte_logit(df))
    assert all(r["coef"] is None and r["converged"] is False for r in got)
    assert rows(ex.hte_main_effect(df))[0]["coef"] is None


def test_no_control_arm_is_an_error(spark):
    data = [d for d in simulated(4, 20) if d[3] != "control"]
    with pytest.raises(ValueError, match="control arm"):
        ex.hte_logit(spark.createDataFrame(data, SESSION))
