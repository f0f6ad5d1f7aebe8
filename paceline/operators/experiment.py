"""Experiment health and effect: sample ratio, balance, clustered logit.

Sessions are never fetched. Each statistic is an aggregate per user, then per experiment;
what reaches the driver is one row per covariate cell (a product of small domains, and
checked) and one K-by-K matrix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.functions.stats import Z_975, chi2_sf, normal_two_sided_p
from paceline.operators.sessions import first_session_per_user
from paceline.sources.scratch import written
from paceline.spec import DEFAULT_EXPERIMENT, DEFAULT_FUNNEL, ExperimentSpec, FunnelSpec

MAX_CELLS = 10_000


def arm_counts(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Users per arm, each user counted once in the arm of the earliest session."""
    users = first_session_per_user(sessions, [spec.variant], spec)
    return users.where(F.col(spec.variant).isNotNull()).groupBy(spec.variant).agg(
        F.count(F.lit(1)).alias("users"))


def srm_check(sessions: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
              spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Chi-square test of a 50/50 split over the two named arms, at user level."""
    arm, n = F.col(spec.variant), F.col("users")
    return srm_from_counts(arm_counts(sessions, spec).agg(
        F.coalesce(F.sum(F.when(arm == exp.control, n)), F.lit(0)).alias("n_control"),
        F.coalesce(F.sum(F.when(arm == exp.treatment, n)), F.lit(0)).alias("n_treatment"),
    ), exp)


def srm_from_counts(counts: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT) -> DataFrame:
    """The test itself, from columns ``n_control`` and ``n_treatment``."""
    n0, n1 = F.col("n_control").cast("double"), F.col("n_treatment").cast("double")
    half = (n0 + n1) / 2
    stat = ((n0 - half) ** 2 + (n1 - half) ** 2) / F.nullif(half, F.lit(0.0))
    tested = counts.withColumn("chi2", stat).withColumn("p", chi2_sf(F.col("chi2"), F.lit(1)))
    return tested.select(
        "n_control", "n_treatment",
        F.round("chi2", 6).alias("chi2"),
        F.round("p", 6).alias("p_value"),
        (F.col("p") < exp.srm_alpha).alias("srm_detected"),
    )


def contingency(sessions: DataFrame, covariates: Sequence[str],
                spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Users per (covariate, variant, level), in long form; NULLs are left out."""
    users = first_session_per_user(sessions, [spec.variant, *covariates], spec)
    cells = users.groupBy(spec.variant, *covariates).agg(F.count(F.lit(1)).alias("n"))
    long = cells.select(F.col(spec.variant), "n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("covariate"), F.col(c).cast("string").alias("level")) for c in covariates
    ])))
    return (
        long.where(F.col("level").isNotNull() & F.col(spec.variant).isNotNull())
        .groupBy("covariate", spec.variant, "level").agg(F.sum("n").alias("users"))
    )


def covariate_balance(sessions: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
                      spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Chi-square independence of variant and each covariate, at user level."""
    return balance_from_table(contingency(sessions, exp.covariates, spec), exp, spec)


def balance_from_table(table: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
                       spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """The tests from a long contingency table.

    With N(sum o²/(r·c) − 1) empty cells need no rows. At one degree of freedom the
    continuity correction applies; all |o − e| of a 2×2 table are equal, so it is one
    factor on the plain statistic.
    """
    row = F.sum("users").over(Window.partitionBy("covariate", spec.variant)).cast("double")
    col = F.sum("users").over(Window.partitionBy("covariate", "level")).cast("double")
    all_ = F.sum("users").over(Window.partitionBy("covariate")).cast("double")
    cells = table.select("covariate", spec.variant, "level", F.col("users").cast("double").alias("o"),
                         row.alias("r"), col.alias("c"), all_.alias("n"))
    sums = cells.groupBy("covariate").agg(
        (F.max("n") * (F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))) - 1)).alias("plain"),
        F.max(F.abs(F.col("o") - F.col("r") * F.col("c") / F.col("n"))).alias("gap"),
        ((F.count_distinct(spec.variant) - 1) * (F.count_distinct("level") - 1)).alias("dof"),
    )
    shrunk = (F.col("gap") - F.least(F.lit(0.5), F.col("gap"))) / F.col("gap")
    stat = (F.when((F.col("dof") == 1) & (F.col("gap") > 0), F.col("plain") * shrunk * shrunk)
            .otherwise(F.greatest(F.col("plain"), F.lit(0.0))))
    p = F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_sf(F.col("stat"), F.col("dof")))
    return sums.withColumn("stat", stat).withColumn("p", p).select(
        "covariate", "dof",
        F.round("stat", 6).alias("chi2"),
        F.round("p", 6).alias("p_value"),
        (F.col("p") > exp.balance_alpha).alias("balanced"),
    )


def _interval(coef: Column, se: Column) -> list[Column]:
    return [
        F.round(coef, 6).alias("coef"), F.round(se, 6).alias("std_err"),
        F.round(coef / se, 6).alias("z"),
        F.round(normal_two_sided_p(coef / se), 6).alias("p_value"),
        F.round(coef - F.lit(Z_975) * se, 6).alias("ci_low"),
        F.round(coef + F.lit(Z_975) * se, 6).alias("ci_high"),
    ]


def hte_main_effect(sessions: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
                    spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Variant-only logit with errors clustered by user, in closed form.

    The coefficient is a difference of log-odds. A user's score is
    (y1 − n1·p1)/(N1·p1·q1) − (y0 − n0·p0)/(N0·p0·q0); its sum of squares expands into
    second moments of the per-user counts, so one pass over users is enough. Counts are
    summed as DECIMAL: the square of a very active user's session count can pass 2^63.
    NULL when an arm has no sessions, no purchases or nothing but purchases.
    """
    arm = F.col(spec.variant)
    y = F.col(exp.outcome).cast("long")
    two_arms = sessions.where(arm.isin(exp.control, exp.treatment) & y.isNotNull())
    users = two_arms.groupBy(spec.user).agg(*[
        F.coalesce(F.sum(F.when(arm == name, value)), F.lit(0)).cast("decimal(18,0)").alias(out)
        for name, value, out in [
            (exp.control, F.lit(1), "n0"), (exp.control, y, "y0"),
            (exp.treatment, F.lit(1), "n1"), (exp.treatment, y, "y1"),
        ]
    ])
    names = ["n0", "y0", "n1", "y1"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    moments = users.agg(
        F.count(F.lit(1)).alias("g"),
        *[F.sum(a).cast("double").alias(f"s_{a}") for a in names],
        *[F.sum(F.col(a) * F.col(b)).cast("double").alias(f"m_{a}_{b}") for a, b in pairs],
    )
    n0, n1, y0, y1 = (F.col(f"s_{c}") for c in ("n0", "n1", "y0", "y1"))
    p0, p1 = y0 / F.nullif(n0, F.lit(0.0)), y1 / F.nullif(n1, F.lit(0.0))

    def cross(a: str, b: str) -> Column:
        return F.col(f"m_{a}_{b}" if (a, b) in pairs else f"m_{b}_{a}")

    def residual_product(i: int, j: int, pi: Column, pj: Column) -> Column:
        return (cross(f"y{i}", f"y{j}") - pj * cross(f"y{i}", f"n{j}")
                - pi * cross(f"n{i}", f"y{j}") + pi * pj * cross(f"n{i}", f"n{j}"))

    rates = moments.withColumn("p0", p0).withColumn("p1", p1)
    q0, q1 = F.col("p0"), F.col("p1")
    inside = q0.between(0, 1) & q1.between(0, 1) & (q0 > 0) & (q0 < 1) & (q1 > 0) & (q1 < 1)
    info0, info1 = n0 * q0 * (F.lit(1.0) - q0), n1 * q1 * (F.lit(1.0) - q1)
    meat = (residual_product(1, 1, q1, q1) / (info1 * info1)
            + residual_product(0, 0, q0, q0) / (info0 * info0)
            - F.lit(2.0) * residual_product(1, 0, q1, q0) / (info1 * info0))
    n_all, g = n0 + n1, F.col("g").cast("double")
    factor = g / F.nullif(g - 1, F.lit(0.0)) * (n_all - 1) / F.nullif(n_all - 2, F.lit(0.0))
    fitted = rates.select(
        F.when(inside, F.ln(q1 / (F.lit(1.0) - q1)) - F.ln(q0 / (F.lit(1.0) - q0))).alias("b"),
        F.when(inside, F.sqrt(factor * meat)).alias("se"),
        n_all.cast("long").alias("n_sessions"), F.col("g").alias("n_users"),
    )
    return fitted.select(*_interval(F.col("b"), F.nullif(F.col("se"), F.lit(0.0))), "n_sessions", "n_users")


# -- interaction model -----------------------------------------------------------------


@dataclass(frozen=True)
class Design:
    """Dummy coding of variant, covariates and variant-by-covariate interactions.

    Reference levels: the control arm, and the alphabetically first covariate level.
    """

    variant: str
    arms: tuple[str, ...]
    covariates: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def terms(self) -> list[tuple[tuple[str, str], ...]]:
        arms = [((self.variant, a),) for a in self.arms[1:]]
        levels = [((c, v),) for c, vs in self.covariates for v in vs[1:]]
        return [(), *arms, *levels, *[a + l for c, vs in self.covariates for a in arms
                                      for l in [((c, v),) for v in vs[1:]]]]

    @staticmethod
    def name(term: tuple[tuple[str, str], ...]) -> str:
        return ":".join(f"{c}[T.{v}]" for c, v in term) or "Intercept"

    def matrix(self, cells: Sequence[dict]) -> np.ndarray:
        return np.array([[float(all(cell[c] == v for c, v in t)) for t in self.terms] for cell in cells])


def fit_grouped_logit(x: np.ndarray, n: np.ndarray, y: np.ndarray,
                      max_iter: int = 100) -> tuple[np.ndarray, np.ndarray, bool]:
    """Newton's method on cell counts: (coefficients, information matrix, converged).

    A margin with no or only successes has no finite optimum; the steps then keep growing
    and the fit is reported as not converged.
    """
    beta = np.zeros(x.shape[1])
    info = np.zeros((x.shape[1], x.shape[1]))
    for _ in range(max_iter):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -500, 500)))
        info = (x * (n * p * (1 - p))[:, None]).T @ x
        try:
            step = np.linalg.solve(info, x.T @ (y - n * p))
        except np.linalg.LinAlgError:
            return beta, info, False
        beta = beta + step
        if np.max(np.abs(beta)) > 25:
            return beta, info, False
        if np.max(np.abs(step)) < 1e-11:
            p = 1.0 / (1.0 + np.exp(-(x @ beta)))
            return beta, (x * (n * p * (1 - p))[:, None]).T @ x, True
    return beta, info, False


def _score_outer(user_cells: DataFrame, cells: list[dict], design: Design, p: np.ndarray,
                 spec: FunnelSpec) -> tuple[np.ndarray, int]:
    """Sum over users of score times its transpose, as two aggregates; and the users."""
    keys = [design.variant, *[c for c, _ in design.covariates]]
    k = len(design.terms)
    spark = user_cells.sparkSession
    rows = [(*[cell[c] for c in keys], float(p[i])) for i, cell in enumerate(cells)]
    fitted = spark.createDataFrame(rows, schema=", ".join([*[f"`{c}` string" for c in keys], "p double"]))
    residual = F.col("y") - F.col("n") * F.col("p")

    def selected(term: tuple[tuple[str, str], ...]) -> Column:
        hit = F.lit(True)
        for c, v in term:
            hit = hit & (F.col(c) == v)
        return hit

    scores = (
        user_cells.join(F.broadcast(fitted), keys)  # one row per cell, at most MAX_CELLS
        .groupBy(spec.user)
        .agg(*[F.sum(F.when(selected(t), residual).otherwise(0.0)).alias(f"s{i}")
               for i, t in enumerate(design.terms)])
        .select(*[f"s{i}" for i in range(k)])
    )

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        outer, users = np.zeros((k, k)), 0
        for batch in batches:
            s = batch.to_numpy(dtype=np.float64)
            outer, users = outer + s.T @ s, users + len(s)
        yield pd.DataFrame({"i": range(-1, k), "users": [users] * (k + 1), "line": [[0.0] * k, *outer.tolist()]})

    # One k x k matrix per task, a line of it a row.
    lines = scores.mapInPandas(add_up, "i int, users long, line array<double>")
    summed = lines.groupBy("i").agg(F.sum("users").alias("users"), *[F.sum(F.get("line", F.lit(j))).alias(f"c{j}")
                                                                     for j in range(k)])
    got = {r["i"]: r for r in summed.collect()}
    return np.array([[got[i][f"c{j}"] for j in range(k)] for i in range(k)]), got[-1]["users"]


def hte_logit(sessions: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
              spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """outcome ~ variant * each covariate, errors clustered by user: one row per term.

    Sessions reduce to successes and trials per (user, cell), written once; the fit needs
    only the cell totals and the covariance one more pass over that table. Coefficients
    are NULL and ``converged`` false when the data separate. ``sessions`` and ``observed`` count
    a term's sessions and conversions, ``expected`` what the fit expects of them.
    """
    keys = [spec.variant, *exp.covariates]
    complete = sessions.where(F.col(exp.outcome).isNotNull()).dropna(subset=keys)
    user_cells = written(complete.groupBy(spec.user, *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(exp.outcome).cast("long")).alias("y"),
    ), "user_cells")
    totals = user_cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    cells = [r.asDict() for r in totals.orderBy(*keys).limit(MAX_CELLS + 1).collect()]
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} covariate cells: group the covariates first")
    arms = sorted({c[spec.variant] for c in cells}, key=lambda a: (a != exp.control, a))
    if not arms or arms[0] != exp.control:
        raise ValueError(f"no sessions in the control arm {exp.control!r}")
    design = Design(spec.variant, tuple(arms), tuple(
        (c, tuple(sorted({cell[c] for cell in cells}))) for c in exp.covariates))
    x = design.matrix(cells)
    n = np.array([float(c["n"]) for c in cells])
    y = np.array([float(c["y"]) for c in cells])
    beta, info, converged = fit_grouped_logit(x, n, y)
    schema = ("term string, coef double, std_err double, z double, p_value double, ci_low double, ci_high double, "
              "sessions long, observed long, expected double, converged boolean")
    spark = sessions.sparkSession
    names = [design.name(t) for t in design.terms]
    if not converged:
        return spark.createDataFrame(
            [(t, *[None] * 6, int(s), int(o), None, False) for t, s, o in zip(names, x.T @ n, x.T @ y)], schema)
    p = 1.0 / (1.0 + np.exp(-(x @ beta)))
    outer, groups = _score_outer(user_cells, cells, design, p, spec)
    bread = np.linalg.inv(info)
    total, k = n.sum(), len(names)
    # Without a second user or a session more than terms there is no spread to report.
    spread = groups > 1 and total > k
    factor = groups / (groups - 1) * (total - 1) / (total - k) if spread else 0.0
    se = np.sqrt(np.diag(factor * bread @ outer @ bread))

    def interval(b: float, s: float) -> tuple:
        if not s > 0:
            return float(b), None, None, None, None, None
        return (float(b), float(s), float(b / s), math.erfc(abs(b / s) / math.sqrt(2.0)),
                float(b - Z_975 * s), float(b + Z_975 * s))

    return spark.createDataFrame([
        (t, *interval(b, s), int(sessions_in), int(observed), float(expected), True)
        for t, b, s, sessions_in, observed, expected in zip(names, beta, se, x.T @ n, x.T @ y, x.T @ (n * p))
    ], schema)
