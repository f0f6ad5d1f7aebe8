"""The whole job: landed JSON to published tables, data tests and experiment read-out.

    python -m paceline.plans.build --src <json folder> --out <table folder>
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from paceline.operators import experiment, marts, population, quality, segments, sessions as ses, survival
from paceline.operators.staging import dedup_events, stg_events
from paceline.session import get_session, require_utc, size_shuffles
from paceline.sources.landing import landing_table, read_landing, read_landing_days, read_mixed
from paceline.spec import DEFAULT_EXPERIMENT, DEFAULT_FUNNEL, ExperimentSpec, FunnelSpec


class DataTestFailure(RuntimeError):
    """At least one data test found violating rows."""


def _table(df: DataFrame, out: str, name: str) -> DataFrame:
    path = f"{out}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_tables(stg: DataFrame, out: str, spec: FunnelSpec = DEFAULT_FUNNEL,
                 watched: quality.Watched | None = None) -> dict[str, DataFrame]:
    """All eight tables below ``out`` (full refresh).

    JSON is parsed and events are grouped into sessions once: typed events and session
    facts are written, everything else reads those. Sessions and transitions are views of
    the facts unless a session id turns out to be shared, when the general join is used.
    ``watched`` counts the data tests of single rows while the tables are written.
    """
    watch = watched.watch if watched else lambda df, model, among=None: df
    events = _table(watch(stg, "stg_events"), out, "stg_events")
    facts = ses.session_facts(events, spec)
    facts = watch(watch(facts, "int_sessions"), "int_step_transition", F.col(spec.session).isNotNull())
    facts = _table(facts, out, "session_facts")
    single = quality.unique(facts, spec.session).isEmpty()
    sessions = facts.drop(*[s.first_ts_col for s in spec.steps])
    if single:
        transitions = ses.transitions_from_facts(facts, spec)
    else:
        joined = ses.int_step_transition(events, sessions, spec)
        transitions = _table(watch(joined, "int_step_transition"), out, "int_step_transition")
    made = {
        "fct_conversion_funnel": marts.conversion_funnel(sessions, spec, one_row_per_session=single),
        "fct_session_dropoff": marts.session_dropoff(events, spec),
        "fct_ab_test_summary": marts.ab_test_summary(sessions, spec, one_row_per_session=single),
        "fct_user_retention": marts.user_retention(sessions, spec),
        "fct_ab_transitions": marts.ab_transitions(transitions, spec, one_row_per_session=single),
    }
    made = {name: watch(df, name) for name, df in made.items()}
    # Independent and each small: written side by side so that short stages overlap.
    with ThreadPoolExecutor(len(made)) as pool:
        written = pool.map(lambda item: (item[0], _table(item[1], out, item[0])), made.items())
        return {
            "stg_events": events, "int_sessions": sessions, "int_step_transition": transitions,
            **dict(written),
        }


def save_as_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """Publish to the catalog, replacing what is there."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables visible to ``spark.sql`` by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return counts


def check_tables(tables: Mapping[str, DataFrame], out: str, spec: FunnelSpec = DEFAULT_FUNNEL,
                 watched: quality.Watched | None = None) -> DataFrame:
    """Run every data test, keep the report, and fail if a row violates one."""
    report = _table(quality.run_suite(tables, spec, watched=watched), out, "data_tests")
    failed = report.where("failures > 0").orderBy("model", "test", "column").collect()
    if failed:
        lines = [f"{r.model}.{r.column} {r.test}: {r.failures} of {r.rows_checked}" for r in failed]
        raise DataTestFailure("; ".join(lines))
    return report


def evaluate(tables: Mapping[str, DataFrame], out: str, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
             spec: FunnelSpec = DEFAULT_FUNNEL) -> dict[str, DataFrame]:
    sessions = tables["int_sessions"]
    return {
        "srm_check": _table(experiment.srm_check(sessions, exp, spec), out, "srm_check"),
        "covariate_balance": _table(experiment.covariate_balance(sessions, exp, spec), out, "covariate_balance"),
        "hte_logit": _table(experiment.hte_logit(sessions, exp, spec), out, "hte_logit"),
    }


def explore(tables: Mapping[str, DataFrame], out: str, exp: ExperimentSpec = DEFAULT_EXPERIMENT,
            spec: FunnelSpec = DEFAULT_FUNNEL) -> dict[str, DataFrame]:
    """Velocity, behavioural segments and population from the job's tables, written beside them."""
    events, sessions = tables["stg_events"], tables["int_sessions"]
    features = _table(segments.user_features(sessions, spec), out, "user_features")
    sweep, labelled = segments.kmeans_sweep(features, spec.user)
    hours = events.select(F.date_format(spec.event_ts, "yyyy-MM-dd-HH").alias("hour"), spec.user)
    chapman = _table(population.chapman_estimate(hours, "hour", spec.user), out, "population_estimate")
    return {
        "km_conversion": _table(survival.conversion_curve(sessions, spec), out, "km_conversion"),
        "km_step_transitions": _table(
            survival.step_curves(tables["int_step_transition"], spec, by_variant=True), out, "km_step_transitions"),
        "user_features": features,
        "kmeans_sweep": _table(sweep, out, "kmeans_sweep"),
        "user_segments": _table(segments.segment_profile(labelled, "cluster"), out, "user_segments"),
        "population_estimate": chapman,
        "power_plan": _table(population.power_plan(sessions, [spec.device, spec.channel], exp, spec), out, "power_plan"),
        "population_verdict": _table(population.population_verdict(sessions, chapman, exp, spec), out, "population_verdict"),
    }


def job_input(spark: SparkSession, src: str, *, table: bool = False, mixed: bool = False, first: date | None = None,
              last: date | None = None) -> DataFrame:
    """Landing rows of a JSON folder or, with ``table``, of a catalog table, of some days if given.

    ``mixed`` reads files of any JSON layout instead of a value a line.
    """
    if table:
        return landing_table(spark, src, first, last)
    if first or last:
        if not (first and last) or mixed:
            raise ValueError("a folder is read by lines and from a first to a last day")
        return read_landing_days(spark, src, first, last)
    return read_mixed(spark, src) if mixed else read_landing(spark, src)


def run_job(spark: SparkSession, src: str, out: str, *, dedup: bool = False,
            fail_on_violation: bool = True, exploring: bool = False, spec: FunnelSpec = DEFAULT_FUNNEL,
            exp: ExperimentSpec = DEFAULT_EXPERIMENT, **source) -> dict[str, DataFrame]:
    """Ingest, build, test, evaluate. ``dedup`` drops events landed twice; ``exploring`` adds the
    tables of ``explore``; ``source`` as in ``job_input``."""
    require_utc(spark)
    if not source.get("table"):
        size_shuffles(spark, src)
    staged = stg_events(job_input(spark, src, **source), spec)
    watched = quality.Watched(spec)
    tables = build_tables(dedup_events(staged, spec) if dedup else staged, out, spec, watched)
    if fail_on_violation:
        report = check_tables(tables, out, spec, watched)
    else:
        report = _table(quality.run_suite(tables, spec, watched=watched), out, "data_tests")
    made = {**tables, "data_tests": report, **evaluate(tables, out, exp, spec)}
    return {**made, **explore(tables, out, exp, spec)} if exploring else made


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("--src", required=True, help="folder of JSON files, or a catalog table with --table")
    args.add_argument("--out", required=True)
    args.add_argument("--table", action="store_true")
    args.add_argument("--mixed", action="store_true", help="files of any JSON layout")
    args.add_argument("--first", type=date.fromisoformat, help="first day to load")
    args.add_argument("--last", type=date.fromisoformat, help="last day to load")
    args.add_argument("--dedup", action="store_true")
    args.add_argument("--keep-going", action="store_true", help="evaluate even if a data test fails")
    args.add_argument("--explore", action="store_true", help="velocity, segments and population as well")
    given = args.parse_args()
    results = run_job(get_session("paceline-build"), given.src, given.out, dedup=given.dedup, exploring=given.explore,
                      fail_on_violation=not given.keep_going, table=given.table, mixed=given.mixed,
                      first=given.first, last=given.last)
    for name in ("fct_ab_test_summary", "srm_check", "covariate_balance", "hte_logit"):
        results[name].show(truncate=False)


if __name__ == "__main__":
    main()
