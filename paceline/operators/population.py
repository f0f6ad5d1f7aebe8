"""How many users there are, how many are needed, and whether there are enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paceline.functions.stats import sample_size
from paceline.operators.staging import stg_events
from paceline.sources.landing import DATE_FOLDERS, list_files, read_landing
from paceline.spec import DEFAULT_EXPERIMENT, DEFAULT_FUNNEL, ExperimentSpec, FunnelSpec

# At most this many landed units (files, or any other grain) per capture.
CAPTURE_UNITS = 4_000


def _reached(spec: FunnelSpec, event: str) -> Column:
    s = spec.step(event)
    return F.col(s.reached_col) if s.as_flag else F.col(s.reached_col) > 0


def chapman_from_counts(counts: DataFrame) -> DataFrame:
    """The estimate from ``n1``, ``n2`` and ``overlap``; NaN spread without overlap."""
    n1, n2, m = (F.col(c).cast("double") for c in ("n1", "n2", "overlap"))
    estimate = (n1 + 1) * (n2 + 1) / (m + 1) - 1
    variance = F.when(m > 0, (n1 + 1) * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1) * (m + 1) * (m + 2))
                      ).otherwise(F.lit(float("nan")))
    se = F.sqrt(variance)
    return counts.select(
        "n1", "n2", "overlap",
        F.round(estimate, 4).alias("estimated_users"),
        F.round(se, 4).alias("std_err"),
        F.round(estimate - F.lit(1.96) * se, 4).alias("ci_low"),
        F.round(estimate + F.lit(1.96) * se, 4).alias("ci_high"),
    )


def _overlap(flagged: DataFrame, id_col: str) -> DataFrame:
    """Distinct ids per capture and in both, from rows ``(id, capture)``."""
    ids = flagged.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max((F.col("capture") == 1).cast("int")).alias("in1"),
        F.max((F.col("capture") == 2).cast("int")).alias("in2"),
    )
    return ids.agg(
        F.coalesce(F.sum("in1"), F.lit(0)).alias("n1"),
        F.coalesce(F.sum("in2"), F.lit(0)).alias("n2"),
        F.coalesce(F.sum(F.col("in1") * F.col("in2")), F.lit(0)).alias("overlap"),
    )


def captures(units: DataFrame, unit_col: str, capture_units: int = CAPTURE_UNITS) -> DataFrame:
    """Two disjoint random sets of units, each at most ``capture_units`` and half of all.

    The order is a hash of the unit's name; only the front of it (at most twice
    ``capture_units`` rows) is numbered.
    """
    distinct = units.select(unit_col).where(F.col(unit_col).isNotNull()).distinct()
    shuffled = [F.md5(F.col(unit_col).cast("string")), F.col(unit_col)]
    half = F.least(F.lit(capture_units), F.floor(distinct.agg(F.count(F.lit(1))).scalar() / 2))
    front = distinct.orderBy(*shuffled).limit(2 * capture_units)
    place = F.row_number().over(Window.orderBy(*shuffled))
    return (
        front.withColumn("place", place).withColumn("half", half)
        .where(F.col("place") <= 2 * F.col("half"))
        .select(unit_col, F.when(F.col("place") <= F.col("half"), 1).otherwise(2).alias("capture"))
    )


def chapman_estimate(df: DataFrame, unit_col: str, id_col: str,
                     capture_units: int = CAPTURE_UNITS) -> DataFrame:
    """Mark–recapture estimate of distinct ``id_col`` from two samples of units."""
    chosen = captures(df, unit_col, capture_units)
    # At most 2 * capture_units short rows.
    flagged = df.select(unit_col, id_col).join(F.broadcast(chosen), unit_col)
    return chapman_from_counts(_overlap(flagged, id_col))


def chapman_from_files(spark: SparkSession, path: str, capture_units: int = CAPTURE_UNITS,
                       spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """The same over landed files: names are sampled first and only those files read."""
    picked = captures(list_files(spark, path), "source_file", capture_units).collect()
    parts = []
    for capture in (1, 2):
        files = [r["source_file"] for r in picked if r["capture"] == capture]
        if files:
            users = stg_events(read_landing(spark, files), spec, strict=False).select(spec.user)
            parts.append(users.withColumn("capture", F.lit(capture)))
    if not parts:
        empty = spark.createDataFrame([], f"{spec.user} string, capture int")
        return chapman_from_counts(_overlap(empty, spec.user))
    return chapman_from_counts(_overlap(parts[0].unionByName(parts[1]), spec.user))


def chapman_from_folders(spark: SparkSession, path: str, capture_units: int = CAPTURE_UNITS,
                         spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """The same with the date folders of the landing as units.

    Folder names below the root, unlike file names, are the same however often the files
    are written. At most twice ``capture_units`` folder names reach the driver.
    """
    depth = len(DATE_FOLDERS)
    folder = F.regexp_replace("source_file", "/[^/]*$", "")
    folders = list_files(spark, path).select(
        folder.alias("folder"), F.substring_index(folder, "/", -depth).alias("unit")).distinct()
    picked = captures(folders, "unit", capture_units).join(folders, "unit").collect()
    seen = spark.createDataFrame([], f"{spec.user} string, capture int")
    for capture in (1, 2):
        chosen = [r["folder"] for r in picked if r["capture"] == capture]
        if chosen:
            users = stg_events(read_landing(spark, chosen), spec, strict=False).select(spec.user)
            seen = seen.unionByName(users.withColumn("capture", F.lit(capture)))
    return chapman_from_counts(_overlap(seen, spec.user))


def power_plan(sessions: DataFrame, dims: Sequence[str], exp: ExperimentSpec = DEFAULT_EXPERIMENT,
               spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Checkout sessions needed per arm and segment, from the control arm's own rate."""
    checkout = _reached(spec, exp.checkout_event)
    rates = sessions.where(F.col(spec.variant) == exp.control).groupBy(*dims).agg(
        F.count_if(checkout).alias("checkouts"),
        F.count_if(checkout & F.col(exp.outcome)).alias("purchases"),
    ).withColumn("p1", F.col("purchases") / F.nullif(F.col("checkouts"), F.lit(0)))
    return rates.select(
        *dims, "checkouts", "purchases",
        F.round("p1", 6).alias("baseline_rate"),
        F.round(F.col("p1") * F.lit(1.0 + exp.relative_mde), 6).alias("target_rate"),
        sample_size(F.col("p1"), exp.relative_mde).alias("n_per_arm"),
        (F.lit(2) * sample_size(F.col("p1"), exp.relative_mde)).alias("n_total"),
    )


def _steps_before(exp: ExperimentSpec, spec: FunnelSpec):
    hops = []
    for a, b, _ in spec.hops:
        if a.event == exp.checkout_event:
            break
        hops.append((a, b))
    return hops


def funnel_reach(sessions: DataFrame, dims: Sequence[str], exp: ExperimentSpec = DEFAULT_EXPERIMENT,
                 spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Step-to-step rates up to checkout and their running product, per segment."""
    hops = _steps_before(exp, spec)
    counts = sessions.groupBy(*dims).agg(*[
        F.count_if(_reached(spec, s.event)).alias(s.funnel_col) for s in spec.steps
    ])
    long = counts.select(*dims, F.inline(F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(a.event).alias("from_step"), F.lit(b.event).alias("to_step"),
                 F.col(a.funnel_col).alias("from_sessions"), F.col(b.funnel_col).alias("to_sessions"))
        for i, (a, b) in enumerate(hops, 1)
    ])))
    share = F.col("to_sessions") / F.nullif(F.col("from_sessions"), F.lit(0))
    so_far = Window.partitionBy(*dims).orderBy("step_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none_left = F.min("to_sessions").over(so_far) == 0
    product = F.when(none_left, F.lit(0.0)).otherwise(F.exp(F.sum(F.ln(share)).over(so_far)))
    return long.select(
        *dims, "step_no", "from_step", "to_step", "from_sessions", "to_sessions",
        F.round(share, 6).alias("step_rate"), F.round(product, 6).alias("reach"),
    )


def sessions_per_user(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """How many users have 1, 2, 3 … sessions, with the mean on every row.

    The totals run over the distribution itself, which has at most sqrt(2 * sessions)
    rows: that many different counts need that many sessions.
    """
    per_user = sessions.where(F.col(spec.user).isNotNull()).groupBy(spec.user).agg(
        F.count_distinct(spec.session).alias("sessions"))
    sizes = per_user.groupBy("sessions").agg(F.count(F.lit(1)).alias("users"))
    everyone = Window.partitionBy(F.lit(1))
    users = F.sum("users").over(everyone).cast("double")
    total = F.sum(F.col("users") * F.col("sessions")).over(everyone).cast("double")
    return sizes.select(
        "sessions", "users",
        F.round(F.col("users") / users, 6).alias("share"),
        F.round(total / users, 6).alias("mean_sessions"),
    )


def population_verdict(sessions: DataFrame, estimate: DataFrame, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
                       spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Users required by the power analysis against the estimated population, one row.

    Required users = 2n / (sessions per user * share of sessions reaching checkout).
    """
    hops = _steps_before(exp, spec)
    per_user = sessions.where(F.col(spec.user).isNotNull()).groupBy(spec.user).agg(
        F.count_distinct(spec.session).alias("sessions"),
        *[F.count_if(_reached(spec, s.event)).alias(s.funnel_col) for s in spec.steps],
    )
    totals = per_user.agg(
        (F.sum("sessions") / F.count(F.lit(1))).alias("spu"),
        *[F.sum(s.funnel_col).alias(s.funnel_col) for s in spec.steps],
    )
    reach = F.lit(1.0)
    for a, b in hops:
        reach = reach * (F.col(b.funnel_col) / F.nullif(F.col(a.funnel_col), F.lit(0)))
    needed = totals.select(
        sample_size(F.lit(exp.baseline_rate), exp.relative_mde).alias("n_per_arm"),
        F.col("spu"), reach.alias("reach"),
    ).withColumn("required", F.lit(2.0) * F.col("n_per_arm") / F.nullif(F.col("spu") * F.col("reach"), F.lit(0.0)))
    found = estimate.select(F.struct("estimated_users", "ci_low", "ci_high")).scalar()
    judged = needed.withColumn("found", found)
    return judged.select(
        "n_per_arm",
        F.round("spu", 6).alias("sessions_per_user"),
        F.round("reach", 6).alias("checkout_reach"),
        F.round("required", 2).alias("required_users"),
        F.col("found.estimated_users").alias("estimated_users"),
        F.col("found.ci_low").alias("ci_low"),
        F.col("found.ci_high").alias("ci_high"),
        F.when(F.col("found.estimated_users") >= F.col("required"), "ENOUGH")
        .otherwise("NOT ENOUGH").alias("verdict"),
    )
