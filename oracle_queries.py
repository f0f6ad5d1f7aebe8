"""The registered queries as plain SQL for an independent engine.

Written from the definitions, not from the Spark code: sessions come from lag and a running
sum over all events, retention from each user's list of active days, exits from the greatest
(time, id), distinct counts are literal, curves use plain windows over each group. The data
tests are listed here on their own.
"""

from __future__ import annotations

import re

STEPS = ["view_homepage", "search_product", "view_product_details", "add_to_cart",
         "checkout_initiated", "purchase_completed"]

EVENTS = """
ordered AS (
  SELECT event_id, user_id, ts, event_type, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM events
),
numbered AS (
  SELECT event_id, user_id, ts, event_type AS kind,
         CAST(sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 8 HOUR THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no,
         min(ts) OVER (PARTITION BY user_id) AS first_ts
  FROM ordered
),
stg AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'usr_' || user_id AS user_id,
         'usr_' || user_id || '_s' || session_no AS session_id,
         CASE WHEN kind = 'view' AND event_id % 2 = 0 THEN 'view_homepage'
              WHEN kind = 'view' THEN 'view_product_details'
              ELSE MAP {'signup': 'search_product', 'click': 'add_to_cart', 'error': 'checkout_initiated',
                        'purchase': 'purchase_completed'}[kind] END AS event_type,
         ts AS event_timestamp,
         CASE WHEN (user_id * 7919 + 13) % 97 % 5 < 3 THEN 'control' ELSE 'new_checkout_ui' END AS variant,
         ['Organic', 'Google_Ads', 'Email', 'Direct'][CAST(((user_id * 1299709 + 3) % 103
           + CASE WHEN user_id % 20 = 3 THEN event_id % 2 ELSE 0 END) % 4 + 1 AS INTEGER)] AS acquisition_channel,
         CAST(first_ts AS DATE) AS signup_date,
         CASE WHEN user_id % 20 <> 7 THEN
           ['desktop', 'mobile', 'tablet'][CAST((user_id * 104729 + 7) % 101 % 3 + 1 AS INTEGER)] END AS device
  FROM numbered
)"""

SESSIONS = EVENTS + """,
sessions AS (
  SELECT session_id, user_id, device, variant, max(acquisition_channel) AS acquisition_channel,
         max(signup_date) AS user_signup_date,
         CASE WHEN max(signup_date) = CAST(min(event_timestamp) AS DATE) THEN 'new_user'
              ELSE 'returning_user' END AS user_type,
         min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
         date_diff('second', min(event_timestamp), max(event_timestamp)) AS session_duration,
         count(event_id) AS total_events,
         count(*) FILTER (event_type = 'view_homepage') AS homepage_views,
         count(*) FILTER (event_type = 'search_product') AS has_searched_product,
         count(*) FILTER (event_type = 'view_product_details') AS has_viewed_product,
         count(*) FILTER (event_type = 'add_to_cart') AS added_to_cart,
         count(*) FILTER (event_type = 'checkout_initiated') > 0 AS has_checkout,
         count(*) FILTER (event_type = 'purchase_completed') > 0 AS has_purchased
  FROM stg GROUP BY session_id, user_id, variant, device
)"""

TRANSITIONS = SESSIONS + """,
step_times AS (
  SELECT session_id,
         min(event_timestamp) FILTER (event_type = 'view_homepage') AS homepage_ts,
         min(event_timestamp) FILTER (event_type = 'search_product') AS search_ts,
         min(event_timestamp) FILTER (event_type = 'view_product_details') AS product_view_ts,
         min(event_timestamp) FILTER (event_type = 'add_to_cart') AS add_to_cart_ts,
         min(event_timestamp) FILTER (event_type = 'checkout_initiated') AS checkout_initiated_ts,
         min(event_timestamp) FILTER (event_type = 'purchase_completed') AS purchase_completed_ts
  FROM stg GROUP BY session_id
),
transitions AS (
  SELECT t.session_id, s.user_id, s.device, s.variant, s.acquisition_channel, s.user_type, s.session_end,
         homepage_ts, search_ts, product_view_ts, add_to_cart_ts, checkout_initiated_ts, purchase_completed_ts,
         date_diff('second', homepage_ts, search_ts) AS homepage_to_search_seconds,
         date_diff('second', search_ts, product_view_ts) AS search_to_product_view_seconds,
         date_diff('second', product_view_ts, add_to_cart_ts) AS product_view_to_add_to_cart_seconds,
         date_diff('second', add_to_cart_ts, checkout_initiated_ts) AS add_to_cart_to_checkout_seconds,
         date_diff('second', checkout_initiated_ts, purchase_completed_ts) AS checkout_to_purchase_seconds
  FROM step_times t JOIN sessions s ON t.session_id = s.session_id
)"""


def _rate(num: str, den: str, scale: str = "100e0", digits: int = 2) -> str:
    return f"round({scale} * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), {digits})"


def _loss(num: str, den: str) -> str:
    return f"round(100e0 * (1e0 - CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)), 2)"


FUNNEL = f"""
funnel AS (
  SELECT device, variant, acquisition_channel, user_type,
         count(DISTINCT session_id) AS total_sessions, count(DISTINCT user_id) AS unique_users,
         round(avg(session_duration), 2) AS avg_session_duration,
         count(*) FILTER (homepage_views > 0) AS sessions_with_homepage_view,
         count(*) FILTER (has_searched_product > 0) AS sessions_with_product_search,
         count(*) FILTER (has_viewed_product > 0) AS sessions_with_product_view,
         count(*) FILTER (added_to_cart > 0) AS sessions_with_cart_adds,
         count(*) FILTER (has_checkout) AS sessions_with_checkout,
         count(*) FILTER (has_purchased) AS sessions_with_purchase,
         {_rate('sessions_with_product_view', 'sessions_with_homepage_view')} AS homepage_to_product_rate,
         {_rate('sessions_with_cart_adds', 'sessions_with_product_view')} AS product_to_cart_rate,
         {_rate('sessions_with_checkout', 'sessions_with_cart_adds')} AS cart_to_checkout_rate,
         {_rate('sessions_with_purchase', 'sessions_with_checkout')} AS checkout_to_purchase_rate,
         {_loss('sessions_with_checkout', 'sessions_with_cart_adds')} AS cart_abandonment_rate,
         {_loss('sessions_with_purchase', 'sessions_with_checkout')} AS checkout_abandonment_rate,
         {_rate('sessions_with_purchase', 'total_sessions')} AS overall_conversion_rate
  FROM sessions GROUP BY device, variant, acquisition_channel, user_type
)"""

SUMMARY = f"""
summary AS (
  SELECT variant, count(DISTINCT session_id) AS total_sessions, count(DISTINCT user_id) AS total_users,
         count(*) FILTER (homepage_views = 1) AS sessions_homepage,
         count(*) FILTER (has_viewed_product = 1) AS sessions_product_viewed,
         count(*) FILTER (added_to_cart = 1) AS sessions_added_to_cart,
         count(*) FILTER (has_checkout) AS sessions_checkout,
         count(*) FILTER (has_purchased) AS total_conversions,
         {_rate('total_conversions', 'total_sessions', '1e0', 4)} AS overall_conversion_rate,
         {_rate('total_conversions', 'sessions_checkout', '1e0', 4)} AS checkout_to_purchase_rate,
         round(avg(session_duration), 2) AS avg_session_duration_seconds
  FROM sessions GROUP BY variant
)"""

def _exits(rows: str, session: str, dims: list[str], share: list[str], kind: str, latest: str) -> str:
    """Last event of each session by ``arg_max``; totals of the coarser groups are looked up."""
    packed = ", ".join(f"{d} := {d}" for d in dims)
    shown = ", ".join(f"ended.{d} AS {d}" for d in dims)
    listed = ", ".join(dims)
    whole = " AND ".join(f"t.{d} IS NOT DISTINCT FROM o.{d}" for d in share) or "true"
    return f"""
session_ends AS (
  SELECT {session}, count(*) AS size, arg_max(struct_pack({packed}, kind := {kind}), struct_pack({latest})) AS ended
  FROM {rows} GROUP BY {session}
),
by_kind AS (
  SELECT {shown}, ended.kind AS exit_event, count({session}) AS total_exits,
         count(*) FILTER (size = 1) AS bounced_sessions
  FROM session_ends GROUP BY ALL
),
dropoff AS (
  SELECT {listed}, exit_event, total_exits, bounced_sessions,
         {_rate('total_exits', f'(SELECT sum(o.total_exits) FROM by_kind o WHERE {whole})')} AS exit_percentage
  FROM by_kind t
)"""


DROPOFF = _exits("stg", "session_id", ["device", "variant", "acquisition_channel"], ["device", "variant"],
                 "event_type", "at := event_timestamp, id := event_id")


def _retention(activity: str, user: str, dims: list[str], signup: str, active: str) -> str:
    """Each user's ages in days when active, as a list per cohort; windows filter the lists."""
    keys = ", ".join(dims)
    known = " AND ".join(f"{d} IS NOT NULL" for d in ["joined", *dims, user])

    def users(low: int, high: int) -> str:
        return (f"count(*) FILTER ({known} AND "
                f"len(list_filter(ages, lambda d: d >= {low} AND d <= {high})) > 0)")

    return f"""
lives AS (
  SELECT {user}, {keys}, CAST({signup} AS DATE) AS joined,
         list(date_diff('day', CAST({signup} AS DATE), CAST({active} AS DATE))) AS ages
  FROM {activity} GROUP BY ALL
),
retention AS (
  SELECT joined AS cohort_date, {keys}, count({user}) AS cohort_size,
         {users(0, 0)} AS newest_users, {users(6, 8)} AS first_week_users,
         {users(13, 15)} AS second_week_users, {users(28, 30)} AS month_users,
         {_rate(users(1, 1), f'count({user})')} AS d1_retention_rate,
         {_rate(users(6, 8), f'count({user})')} AS d7_retention_rate,
         {_rate(users(13, 15), f'count({user})')} AS d14_retention_rate
  FROM lives GROUP BY joined, {keys}
)"""


RETENTION = _retention("sessions", "user_id", ["variant", "acquisition_channel"], "user_signup_date", "session_start")

GAPS = ["homepage_to_search_seconds", "search_to_product_view_seconds", "product_view_to_add_to_cart_seconds",
        "add_to_cart_to_checkout_seconds", "checkout_to_purchase_seconds"]

AB_TRANSITIONS = """
ab_transitions AS (
  SELECT variant, device, acquisition_channel, user_type,
         CASE WHEN grouping(device) = 1 THEN 'variant_level' ELSE 'segment_level' END AS grain,
         count(DISTINCT session_id) AS total_sessions,
         """ + ", ".join(f"round(avg({g}), 2) AS avg_{g}" for g in GAPS) + """
  FROM transitions
  GROUP BY GROUPING SETS ((variant, device, acquisition_channel, user_type), (variant))
)"""

ALL_TABLES = ",".join([TRANSITIONS, FUNNEL, SUMMARY, DROPOFF, RETENTION, AB_TRANSITIONS])

# Model name to the CTE that defines it.
MODELS = {
    "stg_events": "stg", "int_sessions": "sessions", "int_step_transition": "transitions",
    "fct_conversion_funnel": "funnel", "fct_session_dropoff": "dropoff", "fct_ab_test_summary": "summary",
    "fct_user_retention": "retention", "fct_ab_transitions": "ab_transitions",
}


ARMS = ["control", "new_checkout_ui"]
DEVICES = ["desktop", "mobile", "tablet"]
CHANNELS = ["Organic", "Google_Ads", "Email", "Direct"]
VISITS = ["new_user", "returning_user"]
REACHED_BY = ["homepage_views", "has_searched_product", "has_viewed_product", "added_to_cart", "has_checkout",
              "has_purchased"]

# The declared data tests, by table: columns without NULL, keys, accepted values
# (a third item limits the rule to rows that match it).
RULES = {
    "stg_events": (
        "event_id user_id session_id variant event_type event_timestamp device ingested_at acquisition_channel "
        "signup_date",
        ["event_id"],
        [("variant", ARMS), ("event_type", STEPS), ("device", DEVICES), ("acquisition_channel", CHANNELS)]),
    "int_sessions": (
        "session_id user_id variant device acquisition_channel user_type " + " ".join(REACHED_BY),
        ["session_id"],
        [("variant", ARMS), ("user_type", VISITS), *[(c, [0, 1]) for c in REACHED_BY]]),
    "int_step_transition": (
        "session_id user_id device variant acquisition_channel user_type homepage_ts session_end",
        ["session_id"],
        [("device", DEVICES), ("variant", ARMS), ("acquisition_channel", CHANNELS), ("user_type", VISITS)]),
    "fct_conversion_funnel": (
        "variant device acquisition_channel user_type total_sessions unique_users overall_conversion_rate",
        [],
        [("variant", ARMS), ("device", DEVICES), ("acquisition_channel", CHANNELS), ("user_type", VISITS)]),
    "fct_ab_test_summary": (
        "variant total_sessions total_users total_conversions overall_conversion_rate checkout_to_purchase_rate",
        ["variant"],
        [("variant", ARMS)]),
    "fct_user_retention": (
        "cohort_date variant cohort_size d1_retention_rate",
        ["cohort_date,variant,acquisition_channel"],
        [("variant", ARMS)]),
    "fct_ab_transitions": (
        "variant grain total_sessions",
        ["variant,device,acquisition_channel,user_type"],
        [("variant", ARMS), ("grain", ["segment_level", "variant_level"]),
         ("device", DEVICES, "grain = 'segment_level'"), ("acquisition_channel", CHANNELS, "grain = 'segment_level'"),
         ("user_type", VISITS, "grain = 'segment_level'")]),
    "fct_session_dropoff": (
        "exit_event total_exits bounced_sessions",
        ["device,variant,acquisition_channel,exit_event"],
        [("exit_event", STEPS)]),
}


def _rules(model: str, source: str) -> list[str]:
    """One SELECT per declared test of a table."""
    filled, keys, domains = RULES[model]
    out = []

    def report(kind: str, column: str, failures: str, checked: str, rows: str) -> None:
        out.append(f"SELECT '{kind}' AS test, '{model}' AS model, '{column}' AS \"column\", "
                   f"{failures} AS failures, {checked} AS rows_checked FROM {rows}")

    for c in filled.split():
        report("not_null", c, f"count(*) - count({c})", "count(*)", source)
    for key in keys:
        single = "," not in key
        scope = f"WHERE {key} IS NOT NULL" if single else ""
        report("unique" if single else "unique_combination", key, "count(*) FILTER (n > 1)",
               "CAST(coalesce(sum(n), 0) AS BIGINT)", f"(SELECT count(*) AS n FROM {source} {scope} GROUP BY {key})")
    for c, values, *where in domains:
        scope = f"WHERE {where[0]}" if where else ""
        value = f"CAST({c} AS INTEGER)" if values == [0, 1] else c
        report("accepted_values", c, f"count({c}) - count(*) FILTER (list_contains({values}, {value}))", "count(*)",
               f"(SELECT * FROM {source} {scope})")
    return out


def _assertions() -> dict[tuple[str, str], str]:
    """(name, table) to the number of violations, derived from the list of steps."""
    times = [f"CAST({c} AS INTEGER)" for c in REACHED_BY]
    skipped = [f"({times[i]} = 1 AND {times[i - 1]} = 0)" for i in range(2, len(times))]
    skipped.append(f"{times[0]} + {times[1]} = 0")
    active = "newest_users, first_week_users, second_week_users, month_users"
    rates = "d1_retention_rate, d7_retention_rate, d14_retention_rate"
    return {
        ("funnel_monotonicity", "int_sessions"): f"(SELECT count(*) FILTER ({' OR '.join(skipped)}) FROM sessions)",
        ("no_negative_transitions", "int_step_transition"):
            f"(SELECT count(*) FILTER (least({', '.join(GAPS)}) < 0) FROM transitions)",
        ("dropoff_percentage_sum", "fct_session_dropoff"):
            "(SELECT count(*) FILTER (pct < 99 OR pct > 101) FROM "
            "(SELECT round(sum(exit_percentage), 1) AS pct FROM dropoff GROUP BY device, variant))",
        ("no_full_exit_segment", "fct_session_dropoff"):
            "(SELECT CAST(coalesce(sum(whole), 0) AS BIGINT) FROM (SELECT count(*) FILTER (exit_percentage >= 100) "
            "AS whole, sum(total_exits) AS n FROM dropoff WHERE device || variant || acquisition_channel IS NOT NULL "
            "GROUP BY device, variant, acquisition_channel) WHERE n >= 10)",
        ("retention_bounds", "fct_user_retention"):
            f"(SELECT count(*) FILTER (greatest({active}) > cohort_size OR greatest({rates}) > 100 "
            "OR d1_retention_rate < 0) FROM retention)",
    }


def _suite(tables: str, source: dict[str, str], assertions: bool = True) -> str:
    parts = [part for model in source for part in _rules(model, source[model])]
    if assertions:
        of = {MODELS[model]: cte for model, cte in source.items()}
        parts += [f"SELECT '{name}' AS test, '{model}' AS model, '*' AS \"column\", "
                  f"{re.sub(r'FROM ([a-z]+)', lambda m: 'FROM ' + of.get(m[1], m[1]), violations)} AS failures, "
                  f"count(*) AS rows_checked FROM {source[model]}"
                  for (name, model), violations in _assertions().items()]
    return f"WITH {tables} " + " UNION ALL ".join(parts)


def _dq_suite() -> str:
    landed = "landed AS (SELECT *, now() AS ingested_at FROM stg)"
    return _suite(f"{ALL_TABLES}, {landed}", {**MODELS, "stg_events": "landed"})


def _damaged_tables() -> str:
    """Every table followed by copies of its rows: odd values, the same again, all columns empty."""
    ctes = []
    for model, cte in MODELS.items():
        source = "landed" if model == "stg_events" else cte
        odd = {c: 9 if values == [0, 1] else "'odd'" for c, values, *_ in RULES[model][2]}
        again = {c: v for c, v in odd.items() if c == "grain"}
        odd = {c: v for c, v in odd.items() if c not in ("grain", "has_checkout", "has_purchased")}
        if cte == "dropoff":
            odd["exit_percentage"] = "100e0"
        if cte == "retention":
            odd["newest_users"] = "cohort_size + 1"

        def copy(new: dict) -> str:
            shown = ", ".join(f"{v} AS {c}" for c, v in new.items())
            return f"SELECT * {f'REPLACE ({shown})' if new else ''} FROM {source}"

        ctes.append(f"bad_{cte} AS ({copy({})} UNION ALL {copy(odd)} UNION ALL {copy(again)} UNION ALL "
                    f"SELECT empty.* FROM {source} s LEFT JOIN {source} empty ON false)")
    landed = "landed AS (SELECT *, now() AS ingested_at FROM stg)"
    return _suite(", ".join([ALL_TABLES, landed, *ctes]), {m: f"bad_{cte}" for m, cte in MODELS.items()})


# Staged events followed by damaged copies of them: see the query of the same name.
DAMAGED = EVENTS + """,
damaged AS (
  SELECT event_id, user_id, session_id, event_type, event_timestamp, variant, acquisition_channel, signup_date, device,
         now() AS ingested_at FROM stg
  UNION ALL
  SELECT event_id, CASE WHEN hash_id % 2 = 0 THEN user_id END, CASE WHEN hash_id % 3 = 0 THEN session_id END,
         CASE WHEN hash_id % 5 = 0 THEN 'unknown_step' ELSE event_type END, event_timestamp,
         CASE WHEN hash_id % 7 = 0 THEN 'third_arm' WHEN hash_id % 7 > 1 THEN variant END,
         CASE WHEN hash_id % 11 = 0 THEN 'Billboard' WHEN hash_id % 11 > 1 THEN acquisition_channel END,
         CASE WHEN hash_id % 13 > 0 THEN signup_date END, CASE WHEN hash_id % 17 = 0 THEN 'watch' ELSE device END,
         CASE WHEN hash_id % 19 > 0 THEN now() END
  FROM (SELECT *, CAST(event_id AS BIGINT) AS hash_id FROM stg)
  UNION ALL
  SELECT NULL, user_id, session_id, NULL, NULL, variant, acquisition_channel, signup_date, device, now()
  FROM stg WHERE CAST(event_id AS BIGINT) % 23 = 0
)"""


USERS = """
first_sessions AS (
  SELECT user_id, variant, device, acquisition_channel,
         row_number() OVER (PARTITION BY user_id ORDER BY session_start, session_id) AS rn
  FROM sessions
),
users AS (SELECT user_id, variant, device, acquisition_channel FROM first_sessions WHERE rn = 1)"""

TABLE = """
contingency AS (
  SELECT 'device' AS covariate, variant, device AS level, count(*) AS users FROM users
  WHERE device IS NOT NULL GROUP BY variant, device
  UNION ALL
  SELECT 'acquisition_channel', variant, acquisition_channel, count(*) FROM users
  WHERE acquisition_channel IS NOT NULL GROUP BY variant, acquisition_channel
)"""


def _erfc(x: str) -> str:
    """1 - erf(x) from the all-positive series, each term through log-gamma:
    2^n x^(2n+1) / (2n+1)!! = exp(2n ln 2 + (2n+1) ln x + lgamma(n+1) - lgamma(2n+2))."""
    term = (f"exp(2 * n * ln(2e0) + (2 * n + 1) * ln({x}) + lgamma(n + 1e0) - lgamma(2 * n + 2e0))")
    series = f"list_sum(list_transform(range(0, 200), lambda n: {term}))"
    return (f"(CASE WHEN {x} = 0 THEN 1e0 WHEN {x} > 6 THEN 0e0 "
            f"ELSE greatest(0e0, 1e0 - 2e0 / sqrt(pi()) * exp(-({x}) * ({x})) * {series}) END)")


def _chi2_p(x: str, dof: str) -> str:
    """Closed forms for the few degrees of freedom that occur (1, 2, 3)."""
    half = f"({x} / 2e0)"
    return (f"(CASE {dof} WHEN 1 THEN {_erfc(f'sqrt({half})')} WHEN 2 THEN exp(-{half}) "
            f"WHEN 3 THEN {_erfc(f'sqrt({half})')} + 2e0 * sqrt({half} / pi()) * exp(-{half}) END)")


def _interval(source: str, extra: str) -> str:
    return f"""SELECT round(b, 6) AS coef, round(se, 6) AS std_err, round(b / se, 6) AS z,
       round({_erfc('(abs(b / se) / sqrt(2e0))')}, 6) AS p_value,
       round(b - 1.959963984540054e0 * se, 6) AS ci_low, round(b + 1.959963984540054e0 * se, 6) AS ci_high, {extra}
FROM {source}"""


MAIN_EFFECT = f"""WITH {SESSIONS},
arms AS (
  SELECT variant, count(*) AS n, avg(CAST(has_purchased AS DOUBLE)) AS p FROM sessions
  WHERE variant IN ('control', 'new_checkout_ui') GROUP BY variant
),
scores AS (
  SELECT user_id, sum((CASE WHEN variant = 'control' THEN -1e0 ELSE 1e0 END)
                      * (CAST(has_purchased AS DOUBLE) - p) / (n * p * (1 - p))) AS s
  FROM sessions JOIN arms USING (variant) GROUP BY user_id
),
fitted AS (
  SELECT (SELECT ln(p / (1 - p)) FROM arms WHERE variant = 'new_checkout_ui')
         - (SELECT ln(p / (1 - p)) FROM arms WHERE variant = 'control') AS b,
         sqrt(sum(s * s) * count(*) / (count(*) - 1e0) * ((SELECT sum(n) FROM arms) - 1e0)
              / ((SELECT sum(n) FROM arms) - 2e0)) AS se,
         (SELECT CAST(sum(n) AS BIGINT) FROM arms) AS n_sessions, count(*) AS n_users
  FROM scores
)
{_interval('fitted', 'n_sessions, n_users')}"""


def _km(source: str, groups: list[str], t: str, event: str) -> str:
    keys = ", ".join(groups)
    return f"""
points AS (
  SELECT {keys}, CAST({t} AS DOUBLE) AS t, count(*) FILTER ({event}) AS events, count(*) AS gone
  FROM {source} GROUP BY {keys}, CAST({t} AS DOUBLE)
),
risk AS (
  SELECT *, CAST(sum(gone) OVER (PARTITION BY {keys} ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS at_risk
  FROM points
),
logs AS (
  SELECT *,
    sum(CASE WHEN events < at_risk THEN ln(1e0 - events / CAST(at_risk AS DOUBLE)) ELSE 0 END)
      OVER (PARTITION BY {keys} ORDER BY t ROWS UNBOUNDED PRECEDING) AS log_s,
    sum(CASE WHEN events < at_risk THEN events / (CAST(at_risk AS DOUBLE) * (at_risk - events)) ELSE 0 END)
      OVER (PARTITION BY {keys} ORDER BY t ROWS UNBOUNDED PRECEDING) AS var_s
  FROM risk
),
curve AS (
  SELECT *, CASE WHEN events = at_risk THEN 0e0 ELSE exp(log_s) END AS s FROM logs
)
SELECT {keys}, t, at_risk, events, gone - events AS censored, round(s, 6) AS survival,
  CASE WHEN log_s < 0 AND s > 0 THEN
    round(exp(-exp(ln(-log_s) + 1.959963984540054e0 * sqrt(var_s) / abs(log_s))), 6) END AS ci_low,
  CASE WHEN log_s < 0 AND s > 0 THEN
    round(exp(-exp(ln(-log_s) - 1.959963984540054e0 * sqrt(var_s) / abs(log_s))), 6) END AS ci_high
FROM curve"""


def _step_rows() -> str:
    steps = ["homepage_ts", "search_ts", "product_view_ts", "add_to_cart_ts", "checkout_initiated_ts",
             "purchase_completed_ts"]
    parts = []
    for a, b, gap in zip(steps, steps[1:], GAPS):
        parts.append(f"""SELECT session_id, variant, '{gap.removesuffix('_seconds')}' AS transition,
          CASE WHEN {b} IS NOT NULL THEN CAST({gap} AS DOUBLE)
               ELSE date_diff('microsecond', {a}, session_end) / 1e6 END AS duration,
          {b} IS NOT NULL AS advanced
        FROM transitions WHERE {a} IS NOT NULL""")
    return "durations AS (" + " UNION ALL ".join(parts) + ")"


FEATURES = """
per_session AS (
  SELECT *, date_diff('day', user_signup_date, CAST(session_start AS DATE)) AS days,
         CAST(homepage_views > 0 AS INTEGER) + CAST(has_searched_product > 0 AS INTEGER)
         + CAST(has_viewed_product > 0 AS INTEGER) + CAST(added_to_cart > 0 AS INTEGER)
         + CAST(has_checkout AS INTEGER) + CAST(has_purchased AS INTEGER) AS depth
  FROM sessions
),
features AS (
  SELECT user_id, max(days) AS days_since_signup, CAST(max(depth) AS BIGINT) AS max_funnel_depth,
         avg(CAST(total_events <= 1 AS INTEGER)) AS bounce_rate, count(DISTINCT session_id) AS total_sessions,
         avg(session_duration) AS avg_duration, CAST(sum(CAST(has_purchased AS INTEGER)) AS BIGINT) AS total_purchase,
         CAST(sum(added_to_cart) AS BIGINT) AS cart_additions
  FROM per_session GROUP BY user_id
)"""
FEATURE_NAMES = ["days_since_signup", "max_funnel_depth", "bounce_rate", "total_sessions", "avg_duration",
                 "total_purchase", "cart_additions"]

SILHOUETTE = """WITH sample AS (
  SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
  ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id LIMIT 10000
),
to_cluster AS (
  SELECT a.vec_id, a.label AS own, b.label AS other,
         sum(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))
           FILTER (a.vec_id <> b.vec_id) AS total,
         count(*) FILTER (a.vec_id <> b.vec_id) AS peers
  FROM sample a CROSS JOIN sample b GROUP BY a.vec_id, a.label, b.label
),
scored AS (
  SELECT vec_id, own, max(CASE WHEN own = other THEN total / nullif(peers, 0) END) AS inside,
         max(CASE WHEN own = other THEN peers END) AS own_peers,
         min(CASE WHEN own <> other THEN total / peers END) AS nearest
  FROM to_cluster GROUP BY vec_id, own
)
SELECT 'label' AS labelling, count(*) AS points, count(DISTINCT own) AS clusters,
       round(avg(CASE WHEN own_peers > 0 THEN (nearest - inside) / greatest(nearest, inside) ELSE 0 END), 5)
         AS silhouette
FROM scored"""

SILHOUETTE_ALL = """WITH vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
),
to_cluster AS (
  SELECT a.vec_id, a.label AS own, b.label AS other, count(*) AS peers,
         sum(list_distance(a.v, b.v) * list_distance(a.v, b.v)) AS total
  FROM vectors a CROSS JOIN vectors b GROUP BY a.vec_id, a.label, b.label
),
scored AS (
  SELECT vec_id, max(CASE WHEN own = other THEN total / nullif(peers - 1, 0) END) AS inside,
         min(CASE WHEN own <> other THEN total / peers END) AS nearest
  FROM to_cluster GROUP BY vec_id
)
SELECT 'label' AS labelling, round(avg(CASE WHEN inside IS NULL THEN 0
         ELSE (nearest - inside) / greatest(nearest, inside) END), 5) AS silhouette
FROM scored"""


def _terms() -> str:
    """Sessions and conversions per term of the interaction model, by counting."""
    levels = {"device": DEVICES, "acquisition_channel": sorted(CHANNELS)}
    arm = "variant = 'new_checkout_ui'"
    terms = {"Intercept": "true", "variant[T.new_checkout_ui]": arm}
    for c, values in levels.items():
        for v in values[1:]:
            terms[f"{c}[T.{v}]"] = f"{c} = '{v}'"
            terms[f"variant[T.new_checkout_ui]:{c}[T.{v}]"] = f"{arm} AND {c} = '{v}'"
    parts = [f"SELECT '{name}' AS term, count(*) FILTER ({hit}) AS sessions, "
             f"count(*) FILTER ({hit} AND has_purchased) AS observed FROM known" for name, hit in terms.items()]
    known = "known AS (SELECT * FROM sessions WHERE variant || device || acquisition_channel IS NOT NULL)"
    return (f"WITH {SESSIONS}, {known} SELECT *, CAST(observed AS DOUBLE) AS expected, true AS converged FROM ("
            + " UNION ALL ".join(parts) + ")")


def _kmeans_check() -> str:
    means = ", ".join(f"round(avg({c}), 4) AS {c}" for c in FEATURE_NAMES)
    return f"""WITH {SESSIONS}, {FEATURES}
        SELECT k, users, CAST(k AS BIGINT) AS clusters, true AS settled, CAST(0 AS BIGINT) AS displaced_centres,
               true AS cost_falls, {', '.join(FEATURE_NAMES)}
        FROM (SELECT count(*) AS users, {means} FROM features), (SELECT unnest([2, 3, 4, 5]) AS k)"""


def _chapman(seen_in: str, unit: str, who: str, most: int) -> str:
    return f"""
hours AS (SELECT {unit} AS hour, {who} AS user_id FROM {seen_in}),
units AS (SELECT hour, row_number() OVER (ORDER BY md5(hour), hour) AS place, count(*) OVER () AS total
          FROM (SELECT DISTINCT hour FROM hours)),
half AS (SELECT hour, place, least({most}, total // 2) AS h FROM units),
seen AS (
  SELECT user_id, max(CASE WHEN place <= h THEN 1 ELSE 0 END) AS in1,
         max(CASE WHEN place > h AND place <= 2 * h THEN 1 ELSE 0 END) AS in2
  FROM hours JOIN half USING (hour) WHERE user_id IS NOT NULL AND place <= 2 * h GROUP BY user_id
),
sizes AS (
  SELECT CAST(coalesce(sum(in1), 0) AS BIGINT) AS n1, CAST(coalesce(sum(in2), 0) AS BIGINT) AS n2,
         CAST(coalesce(sum(in1 * in2), 0) AS BIGINT) AS overlap FROM seen
),
spread AS (
  SELECT *, (n1 + 1e0) * (n2 + 1) / (overlap + 1) - 1 AS est,
         CASE WHEN overlap > 0 THEN sqrt((n1 + 1e0) * (n2 + 1) * (n1 - overlap) * (n2 - overlap)
              / ((overlap + 1e0) * (overlap + 1) * (overlap + 2))) ELSE CAST('NaN' AS DOUBLE) END AS se
  FROM sizes
),
chapman AS (
  SELECT n1, n2, overlap, round(est, 4) AS estimated_users, round(se, 4) AS std_err,
         round(est - 1.96e0 * se, 4) AS ci_low, round(est + 1.96e0 * se, 4) AS ci_high FROM spread
)"""


CHAPMAN = _chapman("events", "strftime(ts, '%Y-%m-%d-%H')", "user_id", 4000)


def _sample_size(p1: str) -> str:
    p2 = f"({p1} * 1.1e0)"
    mean = f"(({p1} + {p2}) / 2e0)"
    num = (f"pow(1.96e0 * sqrt(2e0 * {mean} * (1e0 - {mean})) "
           f"+ 0.8416e0 * sqrt({p1} * (1e0 - {p1}) + {p2} * (1e0 - {p2})), 2)")
    return f"(CASE WHEN {p1} > 0 AND {p2} <= 1 THEN CAST(ceil({num} / pow({p2} - {p1}, 2)) AS BIGINT) END)"


POWER = f"""WITH {SESSIONS},
rates AS (
  SELECT device, acquisition_channel, count(*) FILTER (has_checkout) AS checkouts,
         count(*) FILTER (has_checkout AND has_purchased) AS purchases,
         count(*) FILTER (has_checkout AND has_purchased)
           / nullif(CAST(count(*) FILTER (has_checkout) AS DOUBLE), 0) AS p1
  FROM sessions WHERE variant = 'control' GROUP BY device, acquisition_channel
)
SELECT device, acquisition_channel, checkouts, purchases, round(p1, 6) AS baseline_rate,
       round(p1 * 1.1e0, 6) AS target_rate, {_sample_size('p1')} AS n_per_arm,
       CAST(2 * {_sample_size('p1')} AS BIGINT) AS n_total
FROM rates"""

REACHED = """
reached AS (
  SELECT variant, device, count(*) FILTER (homepage_views > 0) AS c1, count(*) FILTER (has_searched_product > 0) AS c2,
         count(*) FILTER (has_viewed_product > 0) AS c3, count(*) FILTER (added_to_cart > 0) AS c4,
         count(*) FILTER (has_checkout) AS c5
  FROM sessions GROUP BY variant, device
)"""


def _funnel_reach() -> str:
    parts = []
    for i in range(1, 5):
        product = " * ".join(f"(c{j + 1} / nullif(CAST(c{j} AS DOUBLE), 0))" for j in range(1, i + 1))
        parts.append(f"""SELECT variant, device, CAST({i} AS INTEGER) AS step_no, '{STEPS[i - 1]}' AS from_step,
          '{STEPS[i]}' AS to_step, c{i} AS from_sessions, c{i + 1} AS to_sessions,
          round(c{i + 1} / nullif(CAST(c{i} AS DOUBLE), 0), 6) AS step_rate,
          round(CASE WHEN {' OR '.join(f'c{j + 1} = 0' for j in range(1, i + 1))} THEN 0e0
                ELSE {product} END, 6) AS reach
        FROM reached""")
    return f"WITH {SESSIONS}, {REACHED} " + " UNION ALL ".join(parts)


VERDICT = f"""WITH {SESSIONS}, {CHAPMAN},
measured AS (
  SELECT {_sample_size('0.05e0')} AS n_per_arm,
         count(DISTINCT session_id) / CAST(count(DISTINCT user_id) AS DOUBLE) AS spu,
         (count(*) FILTER (has_searched_product > 0) / CAST(count(*) FILTER (homepage_views > 0) AS DOUBLE))
         * (count(*) FILTER (has_viewed_product > 0) / CAST(count(*) FILTER (has_searched_product > 0) AS DOUBLE))
         * (count(*) FILTER (added_to_cart > 0) / CAST(count(*) FILTER (has_viewed_product > 0) AS DOUBLE))
         * (count(*) FILTER (has_checkout) / CAST(count(*) FILTER (added_to_cart > 0) AS DOUBLE)) AS reach
  FROM sessions
)
SELECT n_per_arm, round(spu, 6) AS sessions_per_user, round(reach, 6) AS checkout_reach,
       round(2e0 * n_per_arm / (spu * reach), 2) AS required_users, estimated_users, ci_low, ci_high,
       CASE WHEN estimated_users >= 2e0 * n_per_arm / (spu * reach) THEN 'ENOUGH' ELSE 'NOT ENOUGH' END AS verdict
FROM measured, chapman"""

RAW_SESSIONS = f"""WITH {EVENTS},
raw_sessions AS (
  SELECT n.user_id, n.session_no, count(*) FILTER (e.event_type = 'view') AS views,
         count(*) FILTER (e.event_type = 'purchase') AS purchases
  FROM numbered n JOIN events e ON n.event_id = e.event_id GROUP BY n.user_id, n.session_no
),
user_copies AS (SELECT count(*) AS n FROM raw_sessions WHERE user_id IS NOT NULL GROUP BY user_id),
pair_copies AS (SELECT count(*) AS n FROM raw_sessions GROUP BY user_id, session_no)
SELECT 'accepted_values' AS test, 'raw_sessions' AS model, 'views' AS "column",
       count(*) FILTER (views NOT IN (0, 1)) AS failures, count(*) AS rows_checked FROM raw_sessions
UNION ALL SELECT 'accepted_values', 'raw_sessions', 'purchases',
       count(*) FILTER (views = 0 AND purchases NOT IN (0, 1)), count(*) FILTER (views = 0) FROM raw_sessions
UNION ALL SELECT 'not_null', 'raw_sessions', 'views', count(*) FILTER (views IS NULL), count(*) FROM raw_sessions
UNION ALL SELECT 'unique', 'raw_sessions', 'user_id', count(*) FILTER (n > 1), CAST(sum(n) AS BIGINT) FROM user_copies
UNION ALL SELECT 'unique_combination', 'raw_sessions', 'user_id,session_no', count(*) FILTER (n > 1),
       CAST(sum(n) AS BIGINT) FROM pair_copies"""

ORDERS_RETENTION = f"""WITH firsts AS (
  SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey
),
activity AS (
  SELECT o.o_custkey, c.c_mktsegment, f.first_order, o.o_orderdate
  FROM orders o JOIN firsts f ON o.o_custkey = f.o_custkey JOIN customer c ON c.c_custkey = o.o_custkey
), {_retention('activity', 'o_custkey', ['c_mktsegment'], 'first_order', 'o_orderdate')}
SELECT * FROM retention"""

ORDERS_DROPOFF = f"""WITH placed AS (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey),
{_exits('placed', 'c_custkey', ['c_mktsegment'], ['c_mktsegment'], 'o_orderpriority',
        'at := o_orderdate, id := o_orderkey')}
SELECT * FROM dropoff"""


def oracle() -> dict[str, str]:
    staged = f"WITH {EVENTS} SELECT * FROM stg"
    sessions = f"WITH {SESSIONS} SELECT * FROM sessions"
    transitions = f"WITH {TRANSITIONS} SELECT * FROM transitions"
    funnel = f"WITH {SESSIONS}, {FUNNEL} SELECT * FROM funnel"
    dim_counts = " UNION ALL ".join(
        f"SELECT '{m}' AS table_name, count(*) AS row_count FROM {cte}" for m, cte in MODELS.items())
    order_check = f"""WITH {EVENTS},
        steps AS (SELECT session_id, event_timestamp AS t, list_position({STEPS}, event_type) AS place FROM stg),
        swapped AS (SELECT DISTINCT a.session_id FROM steps a JOIN steps b
                    ON a.session_id = b.session_id AND a.place < b.place AND b.t < a.t)
        SELECT (SELECT count(*) FROM swapped) AS out_of_order_sessions, count(*) AS events_checked FROM stg"""
    attributes = ["variant", "device", "acquisition_channel", "signup_date", "event_type"]
    attribute_check = f"""WITH {EVENTS}, per_user AS (SELECT user_id,
        {', '.join(f'count(DISTINCT {a}) AS {a}' for a in attributes)} FROM stg GROUP BY user_id)
        SELECT {', '.join(f'count(*) FILTER ({a} > 1) AS {a}_changes' for a in attributes)} FROM per_user"""
    srm = f"""WITH {SESSIONS}, {USERS},
        n AS (SELECT count(*) FILTER (variant = 'control') AS n_control,
                     count(*) FILTER (variant = 'new_checkout_ui') AS n_treatment FROM users),
        x AS (SELECT *, pow(n_control - n_treatment, 2) / CAST(n_control + n_treatment AS DOUBLE) AS chi2 FROM n),
        p AS (SELECT *, {_chi2_p('chi2', '1')} AS p FROM x)
        SELECT n_control, n_treatment, round(chi2, 6) AS chi2, round(p, 6) AS p_value, p < 0.01 AS srm_detected
        FROM p"""
    balance = f"""WITH {SESSIONS}, {USERS}, {TABLE},
        arms AS (SELECT covariate, variant, sum(users) AS r FROM contingency GROUP BY covariate, variant),
        levels AS (SELECT covariate, level, sum(users) AS c FROM contingency GROUP BY covariate, level),
        totals AS (SELECT covariate, sum(users) AS n FROM contingency GROUP BY covariate),
        margins AS (SELECT a.covariate, a.variant, l.level, CAST(a.r AS DOUBLE) * l.c / t.n AS e,
                           coalesce(o.users, 0) AS users
                    FROM arms a JOIN levels l ON a.covariate = l.covariate JOIN totals t ON a.covariate = t.covariate
                    LEFT JOIN contingency o ON o.covariate = a.covariate AND o.variant = a.variant
                      AND o.level = l.level),
        x AS (SELECT covariate, sum(pow(users - e, 2) / e) AS chi2,
                     (count(DISTINCT variant) - 1) * (count(DISTINCT level) - 1) AS dof FROM margins GROUP BY covariate),
        p AS (SELECT *, {_chi2_p('chi2', 'dof')} AS p FROM x)
        SELECT covariate, dof, round(chi2, 6) AS chi2, round(p, 6) AS p_value, p > 0.05 AS balanced FROM p"""
    z = ", ".join(
        f"round(({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
        f"ELSE stddev_pop({c}) OVER () END), 6) AS {c}" for c in FEATURE_NAMES)
    profile = ", ".join(f"round(avg({c}), 6) AS {c}" for c in FEATURE_NAMES if c != "max_funnel_depth")
    spu = f"""WITH {SESSIONS}, per_user AS (SELECT user_id, count(DISTINCT session_id) AS sessions
              FROM sessions GROUP BY user_id)
        SELECT sessions, count(*) AS users, round(count(*) / CAST((SELECT count(*) FROM per_user) AS DOUBLE), 6) AS share,
               round((SELECT avg(sessions) FROM per_user), 6) AS mean_sessions
        FROM per_user GROUP BY sessions"""
    return {
        "landing_scan": f"""WITH {EVENTS} SELECT event_id, user_id, session_id, event_type,
            strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", device, 'exp_demo' AS experiment_id
            FROM stg""",
        "ndjson_roundtrip": staged,
        "multiline_scan": staged,
        "mixed_scan": f"""WITH {EVENTS},
            numbered_events AS (SELECT event_id, CAST(event_id AS BIGINT) AS n,
                strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS t FROM stg)
            SELECT 'object' AS form, event_id, t AS "timestamp", CAST(1 AS BIGINT) AS items
            FROM numbered_events WHERE n % 3 < 2
            UNION ALL SELECT 'array', arg_min(event_id, n), arg_min(t, n), count(*)
            FROM numbered_events WHERE n % 3 = 2 GROUP BY n // 50
            UNION ALL SELECT 'odd', NULL, NULL, 0 FROM numbered_events WHERE n % 101 = 0""",
        "landing_days": f"{staged} WHERE event_timestamp >= DATE '2024-01-05' AND event_timestamp < DATE '2024-01-07'",
        "landing_by_name": f"{staged} WHERE event_timestamp >= DATE '2024-01-09' AND event_timestamp < DATE '2024-01-13'",
        "stream_flush_counts": """SELECT CAST(2 AS BIGINT) AS runs, count(*) AS landed_rows,
            CAST(1 AS BIGINT) AS failed_flushes, true AS every_batch_counted FROM events""",
        "landing_counts": f"""WITH {EVENTS} SELECT count(*) AS landed_rows, count(*) AS parsed_rows,
            count(*) AS rows_with_id, true AS loaded FROM stg""",
        "json_props": "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events",
        "stg_events": staged,
        "dedup_landing": staged,
        "stream_ingest": staged,
        "stream_notices": staged,
        "stream_ndjson": staged,
        "stream_dedup": staged,
        "stream_dedup_for_good": staged,
        "sessionize_events": f"WITH {EVENTS} SELECT event_id, user_id, session_no FROM numbered",
        "int_sessions": sessions,
        "stream_sessions": sessions,
        "stream_kept_sessions": sessions,
        "stream_retention": f"WITH {SESSIONS}, {RETENTION} SELECT * FROM retention",
        "int_step_transition": transitions,
        "int_step_transition_joined": transitions,
        "fct_conversion_funnel": funnel,
        "fct_conversion_funnel_distinct": funnel,
        "fct_session_dropoff": f"WITH {EVENTS}, {DROPOFF} SELECT * FROM dropoff",
        "fct_ab_test_summary": f"WITH {SESSIONS}, {SUMMARY} SELECT * FROM summary",
        "fct_user_retention": f"WITH {SESSIONS}, {RETENTION} SELECT * FROM retention",
        "fct_ab_transitions": f"WITH {TRANSITIONS}, {AB_TRANSITIONS} SELECT * FROM ab_transitions",
        "built_tables": f"WITH {ALL_TABLES} {dim_counts}",
        "published_tables": f"WITH {ALL_TABLES} {dim_counts}",
        "dq_suite": _dq_suite(),
        "dq_damaged_events": _suite(DAMAGED, {"stg_events": "damaged"}, assertions=False),
        "dq_damaged_tables": _damaged_tables(),
        "event_order_check": order_check,
        "user_attribute_check": attribute_check,
        "repeated_step_check": RAW_SESSIONS,
        "arm_counts": f"WITH {SESSIONS}, {USERS} SELECT variant, count(*) AS users FROM users GROUP BY variant",
        "srm_check": srm,
        "covariate_contingency": f"WITH {SESSIONS}, {USERS}, {TABLE} SELECT * FROM contingency",
        "covariate_balance": balance,
        "hte_main_effect": MAIN_EFFECT,
        "km_conversion": f"WITH {SESSIONS}, {_km('sessions', ['variant'], 'session_duration', 'has_purchased')}",
        "step_durations": f"""WITH {TRANSITIONS}, {_step_rows()}
            SELECT session_id, transition, duration, advanced FROM durations""",
        "km_step_transitions":
            f"WITH {TRANSITIONS}, {_step_rows()}, {_km('durations', ['transition'], 'duration', 'advanced')}",
        "km_step_transitions_by_variant":
            f"WITH {TRANSITIONS}, {_step_rows()}, {_km('durations', ['transition', 'variant'], 'duration', 'advanced')}",
        "user_features": f"WITH {SESSIONS}, {FEATURES} SELECT * FROM features",
        "user_features_scaled": f"WITH {SESSIONS}, {FEATURES} SELECT user_id, {z} FROM features",
        "silhouette_sampled": SILHOUETTE,
        "segment_profile": f"""WITH {SESSIONS}, {FEATURES} SELECT max_funnel_depth, count(*) AS users, {profile}
            FROM features GROUP BY max_funnel_depth""",
        "silhouette_all": SILHOUETTE_ALL,
        "kmeans_check": _kmeans_check(),
        "hte_logit_fit": _terms(),
        "chapman_folders": "WITH " + _chapman("events", "strftime(ts, 'year=%Y/month=%m/day=%d')", "user_id", 5)
            + " SELECT * FROM chapman",
        "chapman_customers": "WITH " + _chapman("orders", "CAST(o_orderdate AS VARCHAR)", "o_custkey", 200)
            + " SELECT * FROM chapman",
        "chapman_users": f"WITH {CHAPMAN} SELECT * FROM chapman",
        "power_plan": POWER,
        "funnel_reach": _funnel_reach(),
        "sessions_per_user": spu,
        "population_verdict": VERDICT,
        "cohort_retention_orders": ORDERS_RETENTION,
        "dropoff_orders": ORDERS_DROPOFF,
    }
