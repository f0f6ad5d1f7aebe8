"""Data tests: declared rules and assertions over the published tables.

A test counts violating rows; it passes at zero. All null and domain rules of one table
are conditional counts in a single aggregate, so a table is read once for them however
many rules it has, or not at all where :class:`Watched` counts them while the table is written. Key
rules need their own grouping; they read only their key columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from paceline.functions.time import boundary_seconds
from paceline.spec import DEFAULT_DOMAINS, DEFAULT_FUNNEL, Domains, FunnelSpec


@dataclass(frozen=True)
class Rule:
    """``kind`` is not_null, accepted_values, unique or unique_combination."""

    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    where: str | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def _plain(model: str, columns: Sequence[str]) -> list[Rule]:
    return [Rule(model, "not_null", (c,)) for c in columns]


def declared_rules(domains: Domains = DEFAULT_DOMAINS) -> list[Rule]:
    """The 88 declared tests, table by table."""
    d = domains

    def accepted(model: str, column: str, values: tuple, where: str | None = None) -> Rule:
        return Rule(model, "accepted_values", (column,), values, where)

    rules: list[Rule] = []

    m = "stg_events"
    rules += _plain(m, ["event_id", "user_id", "session_id", "variant", "event_type", "event_timestamp",
                        "device", "ingested_at", "acquisition_channel", "signup_date"])
    rules += [Rule(m, "unique", ("event_id",)),
              accepted(m, "variant", d.variant), accepted(m, "event_type", d.event_type),
              accepted(m, "device", d.device), accepted(m, "acquisition_channel", d.acquisition_channel)]

    m = "int_sessions"
    reached = ["homepage_views", "has_searched_product", "has_viewed_product", "added_to_cart",
               "has_checkout", "has_purchased"]
    rules += _plain(m, ["session_id", "user_id", "variant", "device", "acquisition_channel", "user_type", *reached])
    rules += [Rule(m, "unique", ("session_id",)),
              accepted(m, "variant", d.variant), accepted(m, "user_type", d.user_type)]
    rules += [accepted(m, c, (0, 1)) for c in reached]

    m = "int_step_transition"
    rules += _plain(m, ["session_id", "user_id", "device", "variant", "acquisition_channel", "user_type",
                        "homepage_ts", "session_end"])
    rules += [Rule(m, "unique", ("session_id",)),
              accepted(m, "device", d.device), accepted(m, "variant", d.variant),
              accepted(m, "acquisition_channel", d.acquisition_channel), accepted(m, "user_type", d.user_type)]

    m = "fct_conversion_funnel"
    rules += _plain(m, ["variant", "device", "acquisition_channel", "user_type", "total_sessions",
                        "unique_users", "overall_conversion_rate"])
    rules += [accepted(m, "variant", d.variant), accepted(m, "device", d.device),
              accepted(m, "acquisition_channel", d.acquisition_channel), accepted(m, "user_type", d.user_type)]

    m = "fct_ab_test_summary"
    rules += _plain(m, ["variant", "total_sessions", "total_users", "total_conversions",
                        "overall_conversion_rate", "checkout_to_purchase_rate"])
    rules += [Rule(m, "unique", ("variant",)), accepted(m, "variant", d.variant)]

    m = "fct_user_retention"
    rules += _plain(m, ["cohort_date", "variant", "cohort_size", "d1_retention_rate"])
    rules += [Rule(m, "unique_combination", ("cohort_date", "variant", "acquisition_channel")),
              accepted(m, "variant", d.variant)]

    m = "fct_ab_transitions"
    segment = "grain = 'segment_level'"
    rules += _plain(m, ["variant", "grain", "total_sessions"])
    rules += [Rule(m, "unique_combination", ("variant", "device", "acquisition_channel", "user_type")),
              accepted(m, "variant", d.variant), accepted(m, "grain", d.grain),
              accepted(m, "device", d.device, segment),
              accepted(m, "acquisition_channel", d.acquisition_channel, segment),
              accepted(m, "user_type", d.user_type, segment)]

    m = "fct_session_dropoff"
    rules += _plain(m, ["exit_event", "total_exits", "bounced_sessions"])
    rules += [Rule(m, "unique_combination", ("device", "variant", "acquisition_channel", "exit_event")),
              accepted(m, "exit_event", d.event_type)]
    return rules


# -- row-level forms -------------------------------------------------------------------


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _not_accepted(df: DataFrame, column: str, values: Sequence) -> Column:
    value = F.col(column)
    if dict(df.dtypes)[column] == "boolean":
        value = value.cast("int")
    return value.isNotNull() & ~value.isin(list(values))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    return df.where(_any([F.col(c).isNull() for c in columns]))


def accepted_values(df: DataFrame, column: str, values: Sequence, where: str | None = None) -> DataFrame:
    """Rows whose non-NULL value is outside ``values``, among rows matching ``where``."""
    return (df.where(where) if where else df).where(_not_accepted(df, column, values))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations (NULLs included) that occur more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


# -- assertions ------------------------------------------------------------------------


def funnel_monotonicity(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL, *,
                        strict: bool = False) -> DataFrame:
    """Sessions that reached a step without the one before it.

    The default looks at steps seen exactly once and its last clause is "neither the
    first nor the second step"; ``strict`` flags any step reached without its
    predecessor, however often it was seen.
    """
    return sessions.where(_not_monotone(spec, strict))


def _not_monotone(spec: FunnelSpec, strict: bool = False) -> Column:
    def seen(i: int) -> Column:
        s = spec.steps[i]
        c = F.col(s.reached_col)
        return c if s.as_flag else (c > 0 if strict else c == 1)

    def missing(i: int) -> Column:
        s = spec.steps[i]
        c = F.col(s.reached_col)
        return ~c if s.as_flag else c == 0

    last = len(spec.steps) - 1
    if strict:
        return _any([seen(i) & missing(i - 1) for i in range(1, last + 1)])
    clauses = [seen(i) & missing(i - 1) for i in range(2, last + 1)]
    return _any([*clauses, missing(1) & missing(0)])


def no_negative_transitions(transitions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    return transitions.where(_any([F.col(gap) < 0 for _, _, gap in spec.hops]))


def dropoff_percentage_sum(dropoff: DataFrame, share_within: Sequence[str] = ("device", "variant")) -> DataFrame:
    """Groups whose exit percentages do not add up to about 100."""
    total = F.round(F.sum("exit_percentage"), 1)
    return (dropoff.groupBy(*share_within).agg(total.alias("total_segment_pct"))
            .where(~F.col("total_segment_pct").between(99.0, 101.0)))


def no_full_exit_segment(dropoff: DataFrame, segment: Sequence[str] = ("device", "variant", "acquisition_channel"),
                         min_exits: int = 10) -> DataFrame:
    """Exit events that take a whole group, in segments with enough exits to matter.

    A segment with a NULL key is left out, as an equality join would leave it out.
    """
    total = F.sum("total_exits").over(Window.partitionBy(*segment))
    keyed = dropoff.where(~_any([F.col(c).isNull() for c in segment]))
    return (keyed.withColumn("total_segment_exits", total)
            .where((F.col("exit_percentage") >= 100.0) & (F.col("total_segment_exits") >= min_exits)))


def retention_bounds(retention: DataFrame) -> DataFrame:
    """Cohorts with more active users than members, or a rate outside 0..100."""
    return retention.where(_out_of_bounds())


def _out_of_bounds() -> Column:
    too_many = [F.col(c) > F.col("cohort_size") for c in
                ("newest_users", "first_week_users", "second_week_users", "month_users")]
    too_high = [F.col(c) > 100.0 for c in ("d1_retention_rate", "d7_retention_rate", "d14_retention_rate")]
    return _any([*too_many, *too_high, F.col("d1_retention_rate") < 0.0])


def event_order_flags(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """``(session, events, out_of_order)``: whether a later funnel step has an earlier
    time than a step before it.

    Compares each step's first time with the latest time of all earlier steps, from one
    aggregate per session.
    """
    is_step = [F.col(spec.event_type) == s.event for s in spec.steps]
    firsts = [F.min(F.when(c, F.col(spec.event_ts))).alias(f"first_{i}") for i, c in enumerate(is_step)]
    lasts = [F.max(F.when(c, F.col(spec.event_ts))).alias(f"last_{i}") for i, c in enumerate(is_step)]
    per_session = stg.groupBy(spec.session).agg(F.count(F.lit(1)).alias("events"), *firsts, *lasts)
    swapped = []
    for i in range(1, len(spec.steps)):
        latest_before = F.col("last_0") if i == 1 else F.greatest(*[f"last_{j}" for j in range(i)])
        swapped.append(F.coalesce(F.col(f"first_{i}") < latest_before, F.lit(False)))
    return per_session.select(spec.session, "events", _any(swapped).alias("out_of_order"))


def event_order(stg: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Sessions whose events are out of funnel order."""
    return event_order_flags(stg, spec).where("out_of_order").select(spec.session)


def changing_attributes(stg: DataFrame, attributes: Sequence[str],
                        spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Users for whom an attribute that should be fixed takes more than one value."""
    spread = [F.min(a).alias(f"min_{a}") for a in attributes] + [F.max(a).alias(f"max_{a}") for a in attributes]
    per_user = stg.groupBy(spec.user).agg(*spread)
    differs = [F.col(f"min_{a}") != F.col(f"max_{a}") for a in attributes]
    return (per_user.where(_any([F.coalesce(d, F.lit(False)) for d in differs]))
            .select(spec.user, *[F.coalesce(d, F.lit(False)).alias(f"{a}_changes")
                                 for a, d in zip(attributes, differs)]))


# -- suite -----------------------------------------------------------------------------


REPORT = "test string, model string, column string, failures long, rows_checked long"


def _row_rules(rules: Sequence[Rule], model: str) -> list[Rule]:
    return [r for r in rules if r.model == model and r.kind in ("not_null", "accepted_values")]


def _row_counts(df: DataFrame, rules: Sequence[Rule], among: Column | None = None) -> list[tuple[Column, Column]]:
    """For each null or domain rule the violating rows and the rows it is about, as aggregates."""
    counts = []
    for r in rules:
        scope = F.expr(r.where) if r.where else F.lit(True)
        scope = scope if among is None else scope & among
        column = r.columns[0]
        bad = F.col(column).isNull() if r.kind == "not_null" else _not_accepted(df, column, r.values)
        counts.append((F.count_if(scope & bad), F.count_if(scope)))
    return counts


def _fold(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All null and domain rules of one table as one aggregate, a row per rule."""
    aggs, rows = [], []
    for i, (r, (bad, seen)) in enumerate(zip(rules, _row_counts(df, rules))):
        aggs += [bad.alias(f"bad_{i}"), seen.alias(f"seen_{i}")]
        rows.append(F.struct(
            F.lit(r.kind).alias("test"), F.lit(r.model).alias("model"), F.lit(r.column).alias("column"),
            F.col(f"bad_{i}").alias("failures"), F.col(f"seen_{i}").alias("rows_checked"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


class Watched:
    """Tests that look at one row at a time, counted by the job that writes a table.

    ``watch`` hangs the counts on a table before it is written; they are metrics of that write,
    summed over its tasks, and ``report`` waits for it. A table that is watched again, or under the name of
    a model watched before, replaces what was counted.
    """

    def __init__(self, spec: FunnelSpec = DEFAULT_FUNNEL, rules: Sequence[Rule] | None = None):
        self.spec = spec
        self.rules = declared_rules() if rules is None else list(rules)
        self.found: dict[str, tuple[Observation, list[tuple[str, str]]]] = {}

    def _assertions(self, model: str) -> list[tuple[str, Column]]:
        """Assertions that look at one row; step gaps are taken from the step times."""
        hops = [(F.col(a.first_ts_col), F.col(b.first_ts_col)) for a, b, _ in self.spec.hops]
        return {
            "int_sessions": [("funnel_monotonicity", _not_monotone(self.spec))],
            "int_step_transition": [("no_negative_transitions", _any([boundary_seconds(a, b) < 0 for a, b in hops]))],
            "fct_user_retention": [("retention_bounds", _out_of_bounds())],
        }.get(model, [])

    def watch(self, df: DataFrame, model: str, among: Column | None = None) -> DataFrame:
        """``df`` with the counts of ``model``; the model is the rows ``among`` if given."""
        rules = _row_rules(self.rules, model)
        scope = F.lit(True) if among is None else among
        counts = _row_counts(df, rules, among)
        counts += [(F.count_if(scope & bad), F.count_if(scope)) for _, bad in self._assertions(model)]
        names = [(r.kind, r.column) for r in rules] + [(name, "*") for name, _ in self._assertions(model)]
        if not names:
            return df
        seen = Observation()
        self.found[model] = (seen, names)
        return df.observe(seen, *[c.alias(f"{kind}_{i}") for i, pair in enumerate(counts) for kind, c in zip(("bad", "seen"), pair)])

    def tests(self, model: str) -> set[str]:
        """The assertions counted for a model."""
        return {name for name, column in self.found[model][1] if column == "*"} if model in self.found else set()

    def report(self, spark: SparkSession, models: Sequence[str]) -> DataFrame:
        """``(test, model, column, failures, rows_checked)`` of the watched ones of ``models``."""
        rows = []
        for model in models:
            if model in self.found:
                seen, names = self.found[model]
                counted = seen.get
                rows += [(test, model, column, counted.get(f"bad_{i}", 0), counted.get(f"seen_{i}", 0))
                         for i, (test, column) in enumerate(names)]
        return spark.createDataFrame(rows, REPORT)


def _keys(df: DataFrame, r: Rule) -> DataFrame:
    scoped = df.where(F.col(r.columns[0]).isNotNull()) if r.kind == "unique" else df
    copies = scoped.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.lit(r.kind).alias("test"), F.lit(r.model).alias("model"), F.lit(r.column).alias("column"),
        F.count_if(F.col("copies") > 1).alias("failures"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_checked"),
    )


def _assertion(name: str, model: str, violations: DataFrame, checked: DataFrame) -> DataFrame:
    return violations.agg(
        F.lit(name).alias("test"), F.lit(model).alias("model"), F.lit("*").alias("column"),
        F.count(F.lit(1)).alias("failures"),
    ).withColumn("rows_checked", checked.agg(F.count(F.lit(1))).scalar())


def run_suite(tables: Mapping[str, DataFrame], spec: FunnelSpec = DEFAULT_FUNNEL,
              rules: Sequence[Rule] | None = None, watched: Watched | None = None) -> DataFrame:
    """``(test, model, column, failures, rows_checked)`` for every rule and assertion
    whose table is given. Pass written tables: each is read several times. What ``watched`` has
    counted while they were written is not counted again."""
    rules = declared_rules() if rules is None else rules
    counted = watched.found if watched else {}
    parts = []
    for model, df in tables.items():
        simple = _row_rules(rules, model)
        if simple and model not in counted:
            parts.append(_fold(df, simple))
        parts += [_keys(df, r) for r in rules if r.model == model and r.kind.startswith("unique")]
    asserted = [
        ("funnel_monotonicity", "int_sessions", lambda t: funnel_monotonicity(t, spec)),
        ("no_negative_transitions", "int_step_transition", lambda t: no_negative_transitions(t, spec)),
        ("dropoff_percentage_sum", "fct_session_dropoff", dropoff_percentage_sum),
        ("no_full_exit_segment", "fct_session_dropoff", no_full_exit_segment),
        ("retention_bounds", "fct_user_retention", retention_bounds),
    ]
    parts += [
        _assertion(name, model, check(tables[model]), tables[model])
        for name, model, check in asserted if model in tables and not (watched and name in watched.tests(model))
    ]
    if counted:
        parts.append(watched.report(next(iter(tables.values())).sparkSession, list(tables)))
    return reduce(DataFrame.unionByName, parts)
