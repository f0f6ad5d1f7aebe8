"""Kaplan–Meier curves as aggregates and windows.

Durations may be fractions of a second, so a curve can have as many points as there are
sessions. Running sums are therefore taken in two levels: over bins (few per group) and inside
each bin, never over one group's points in a single task. Bins are cut by the data: the points are
range-partitioned by group and time and each partition is a bin, so that a million durations
within one second fall into as many bins as a million over a year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from paceline.functions.stats import Z_975
from paceline.functions.time import elapsed_micros
from paceline.sources.scratch import written
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec


def kaplan_meier(df: DataFrame, group_cols: Sequence[str], duration: str, event: str, *,
                 bins: int | None = None, z: float = Z_975) -> DataFrame:
    """``(groups, t, at_risk, events, censored, survival, ci_low, ci_high)``.

    One row per distinct duration. The interval is the log(-log) Greenwood band, NULL
    where it is undefined (survival 1 or 0). Rows with a NULL group or duration are left
    out. ``event`` is boolean. Points per duration are written once: three steps read them.
    There are as many bins as shuffle partitions after adaptive merging, or ``bins``; any number
    gives the same curve. The bin is written with its points, so no later step can cut anew.
    """
    groups = list(group_cols)
    counted = (
        df.dropna(subset=[*groups, duration])
        .groupBy(*groups, F.col(duration).cast("double").alias("t"))
        .agg(F.count_if(F.col(event)).alias("events"), F.count(F.lit(1)).alias("left"))
    )
    by = [*groups, "t"]
    ranged = counted.repartitionByRange(bins, *by) if bins else counted.repartitionByRange(*by)
    points = written(ranged.withColumn("bin", F.spark_partition_id()), "km_points")
    in_bin = Window.partitionBy(*groups, "bin")

    # Still at risk: everyone leaving at t or later = later bins + later in this bin.
    later = Window.partitionBy(*groups).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = points.groupBy(*groups, "bin").agg(F.sum("left").alias("in_bin"))
    after = bins.select(*groups, "bin", F.coalesce(F.sum("in_bin").over(later), F.lit(0)).alias("after_bin"))
    from_t = in_bin.orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = F.col("events").cast("double")
    n = F.col("at_risk").cast("double")
    risk = (
        points.join(after, [*groups, "bin"])
        .withColumn("at_risk", F.col("after_bin") + F.sum("left").over(from_t))
        .withColumn("log_step", F.when(d < n, F.log1p(-d / n)).otherwise(0.0))
        .withColumn("var_step", F.when(d < n, d / (n * (n - d))).otherwise(0.0))
    )

    # Running log-survival and Greenwood sum: earlier bins + earlier in this bin.
    earlier = Window.partitionBy(*groups).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    steps = risk.groupBy(*groups, "bin").agg(
        F.sum("log_step").alias("log_bin"), F.sum("var_step").alias("var_bin"))
    before = steps.select(
        *groups, "bin",
        F.coalesce(F.sum("log_bin").over(earlier), F.lit(0.0)).alias("log_before"),
        F.coalesce(F.sum("var_bin").over(earlier), F.lit(0.0)).alias("var_before"),
    )
    to_t = in_bin.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log_s = F.col("log_before") + F.sum("log_step").over(to_t)
    var_s = F.col("var_before") + F.sum("var_step").over(to_t)
    curve = (
        risk.join(before, [*groups, "bin"])
        .withColumn("log_s", log_s).withColumn("var_s", var_s)
        # Everyone left had the event: nobody remains, survival is exactly zero.
        .withColumn("survival", F.when(d == n, F.lit(0.0)).otherwise(F.exp("log_s")))
    )
    defined = (F.col("log_s") < 0) & (F.col("survival") > 0)
    spread = F.lit(z) * F.sqrt("var_s") / F.abs("log_s")
    center = F.ln(-F.col("log_s"))
    return curve.select(
        *groups, "t", "at_risk", "events",
        (F.col("left") - F.col("events")).alias("censored"),
        F.round("survival", 6).alias("survival"),
        F.when(defined, F.round(F.exp(-F.exp(center + spread)), 6)).alias("ci_low"),
        F.when(defined, F.round(F.exp(-F.exp(center - spread)), 6)).alias("ci_high"),
    )


def conversion_curve(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Time from session start to purchase, per variant; sessions without one are censored."""
    return kaplan_meier(sessions, [spec.variant], "session_duration", spec.steps[-1].reached_col)


def step_durations(transitions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(transition, duration, advanced)``: one row per step a session reached.

    A session that advances has the whole-second gap; one that does not is censored after
    ``session_end - step`` in fractional seconds.
    """
    rows = []
    for a, b, gap in spec.hops:
        start, done = F.col(a.first_ts_col), F.col(b.first_ts_col).isNotNull()
        idle = elapsed_micros(start, F.col("session_end")) / F.lit(1e6)
        rows.append(F.struct(
            F.lit(gap.removesuffix("_seconds")).alias("transition"),
            start.isNotNull().alias("reached"),
            F.when(done, F.col(gap).cast("double")).otherwise(idle).alias("duration"),
            done.alias("advanced"),
        ))
    long = transitions.select(*keep, F.inline(F.array(*rows)))
    return long.where("reached").drop("reached")


def step_curves(transitions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *,
                by_variant: bool = False) -> DataFrame:
    """Time to advance per step; both arms pooled unless ``by_variant``."""
    extra = [spec.variant] if by_variant else []
    long = step_durations(transitions, spec, keep=extra)
    return kaplan_meier(long, ["transition", *extra], "duration", "advanced")
