"""Every registered query: name to ``(spark, table folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paceline.operators import experiment, marts, population, quality, segments, survival
from paceline.operators import sessions as ses
from paceline.operators.sessionize import sessionize
from paceline.operators.staging import dedup_events, stg_events
from paceline.plans.build import DataTestFailure, build_tables, table_counts
from paceline.plans.publish import Publication, publish_tables
from paceline.session import require_utc, size_shuffles
from paceline.sources import landing as land
from paceline.sources.adapter import GAP_HOURS, funnel_events
from paceline.sources.scratch import new_dir, written
from paceline.spec import DEFAULT_EXPERIMENT, DEFAULT_FUNNEL as SPEC, FunnelSpec
from paceline.streaming import (counts as scounts, dedup as sdedup, ingest, notices, retention as sretention,
                                sessions as ssessions)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

EXPERIMENT_ID = "exp_demo"
_landed: dict[tuple[str, str], str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        require_utc(spark)
        size_shuffles(spark, sf_dir)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


# -- shared inputs ---------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_events(read(spark, sf_dir, "events"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter derives session, arm and device from the user: one row per session."""
    return ses.session_facts(events(spark, sf_dir))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ses.int_sessions(events(spark, sf_dir))


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ses.transitions_from_facts(facts(spark, sf_dir))


def landed(spark: SparkSession, sf_dir: str) -> str:
    """The events as dated JSON files, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        path = new_dir(spark, "landing")
        land.write_ndjson(land.payload(events(spark, sf_dir), EXPERIMENT_ID), path, compression="gzip")
        _landed[key] = path
    return _landed[key]


def typed(stg: DataFrame) -> DataFrame:
    return stg.drop("ingested_at")


# -- sources and sinks -----------------------------------------------------------------


@query
def landing_scan(spark, sf_dir):
    rows = land.read_landing(spark, landed(spark, sf_dir))
    return rows.select(*[
        F.variant_get("raw_payload", f"$.{k}", "string").alias(k)
        for k in ("event_id", "user_id", "session_id", "event_type", "timestamp", "device", "experiment_id")
    ])


@query
def ndjson_roundtrip(spark, sf_dir):
    return typed(stg_events(land.read_landing(spark, landed(spark, sf_dir))))


@query
def multiline_scan(spark, sf_dir):
    """Indented documents that span lines."""
    key = (spark.sparkContext.applicationId, sf_dir + "#documents")
    if key not in _landed:
        path = new_dir(spark, "documents")
        land.write_documents(land.payload(events(spark, sf_dir), EXPERIMENT_ID), path)
        _landed[key] = path
    rows = land.read_landing(spark, _landed[key], record_sep=land.RECORD_SEPARATOR, files="*.txt")
    return typed(stg_events(rows))


@query
def mixed_scan(spark, sf_dir):
    """Lines, indented objects, indented arrays and cut lines in the same files, read in ranges
    that cut through them; an array is one row."""
    body = land.payload(events(spark, sf_dir), EXPERIMENT_ID)
    n, whole = F.col("event_id").cast("long"), F.struct(*body.columns)
    line, pretty = F.to_json(whole), {"pretty": "true"}
    several = F.sort_array(F.collect_list(F.struct(n.alias("n"), whole.alias("event"))))  # of 50 numbers at most
    arrays = body.where(n % 3 == 2).groupBy(F.floor(n / 50).alias("group")).agg(several.alias("events"))
    texts = (body.where(n % 3 == 0).select(line.alias("value"))
             .unionAll(body.where(n % 3 == 1).select(F.to_json(whole, pretty)))
             .unionAll(arrays.select(F.to_json(F.transform("events", lambda e: e["event"]), pretty)))
             .unionAll(body.where(n % 101 == 0).select(F.substring(line, 1, 40))))
    path = new_dir(spark, "mixed")
    texts.repartition(8).write.text(path)
    rows = land.read_mixed(spark, path, files="*.txt", split_bytes=1 << 18)
    get = lambda at, kind: F.try_variant_get("raw_payload", at, kind)
    first = lambda k: F.coalesce(get(f"$.{k}", "string"), get(f"$[0].{k}", "string"))
    size = F.size(get("$", "array<variant>"))
    return rows.select(
        F.when(F.col("raw_payload").isNull(), "odd").when(size.isNotNull(), "array").otherwise("object").alias("form"),
        first("event_id").alias("event_id"), first("timestamp").alias("timestamp"),
        F.coalesce(size, F.col("raw_payload").isNotNull().cast("int")).cast("long").alias("items"))


@query
def landing_days(spark, sf_dir):
    """Two days of the landing, from their date folders alone."""
    rows = land.read_landing_days(spark, landed(spark, sf_dir), date(2024, 1, 5), date(2024, 1, 6))
    return typed(stg_events(rows))


@query
def landing_by_name(spark, sf_dir):
    """A landing table bound by its catalog name, one month day of its partitions."""
    name = f"landing_{new_dir(spark, 'landing').rsplit('-', 1)[1]}"
    body = land.with_date_folders(land.payload(events(spark, sf_dir), EXPERIMENT_ID))
    text = F.to_json(F.struct(*[c for c in body.columns if c not in land.DATE_FOLDERS])).alias("value")
    (body.select(text, *land.DATE_FOLDERS).write.partitionBy(*land.DATE_FOLDERS)
     .option("path", new_dir(spark, "landing-table")).saveAsTable(name))
    return typed(stg_events(land.landing_table(spark, name, date(2024, 1, 9), date(2024, 1, 12))))


@query
def landing_counts(spark, sf_dir):
    counts = land.landing_counts(land.read_landing(spark, landed(spark, sf_dir)))
    return counts.select("landed_rows", "parsed_rows", "rows_with_id",
                         (F.col("first_load") <= F.col("last_load")).alias("loaded"))


@query
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))


# -- staging and sessions --------------------------------------------------------------


@query
def stg_events_model(spark, sf_dir):
    return typed(stg_events(land.landing_from_events(events(spark, sf_dir), EXPERIMENT_ID)))


QUERIES["stg_events"] = QUERIES.pop("stg_events_model")


@query
def dedup_landing(spark, sf_dir):
    path = landed(spark, sf_dir)
    twice = land.read_landing(spark, path).unionAll(land.read_landing(spark, path))
    return typed(dedup_events(stg_events(twice)))


@query
def sessionize_events(spark, sf_dir):
    raw = read(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return sessionize(raw, "user_id", "ts", GAP_HOURS).select("event_id", "user_id", "session_no")


@query
def int_sessions(spark, sf_dir):
    return sessions(spark, sf_dir)


@query
def int_step_transition(spark, sf_dir):
    return transitions(spark, sf_dir)


@query
def int_step_transition_joined(spark, sf_dir):
    """The general form, for input where a session id may be shared."""
    stg = events(spark, sf_dir)
    return ses.int_step_transition(stg, ses.int_sessions(stg))


# -- published tables ------------------------------------------------------------------


@query
def fct_conversion_funnel(spark, sf_dir):
    return marts.conversion_funnel(sessions(spark, sf_dir), one_row_per_session=True)


@query
def fct_conversion_funnel_distinct(spark, sf_dir):
    """The same with exact distinct counts, for input where a session id may repeat."""
    return marts.conversion_funnel(sessions(spark, sf_dir))


@query
def fct_session_dropoff(spark, sf_dir):
    return marts.session_dropoff(events(spark, sf_dir))


@query
def fct_ab_test_summary(spark, sf_dir):
    return marts.ab_test_summary(sessions(spark, sf_dir), one_row_per_session=True)


@query
def fct_user_retention(spark, sf_dir):
    return marts.user_retention(sessions(spark, sf_dir))


@query
def fct_ab_transitions(spark, sf_dir):
    return marts.ab_transitions(transitions(spark, sf_dir), one_row_per_session=True)


@query
def built_tables(spark, sf_dir):
    return table_counts(build_tables(events(spark, sf_dir), new_dir(spark, "tables")))


@query
def published_tables(spark, sf_dir):
    """What readers see after one publication and a second one whose data tests fail."""
    path, stg = new_dir(spark, "published"), events(spark, sf_dir)
    publish_tables(spark, stg, path, fail_on_violation=False)
    try:
        publish_tables(spark, stg.where("event_type <> 'view_homepage'"), path)
    except DataTestFailure:
        pass
    published = Publication(spark, path).tables()
    return table_counts({n: df for n, df in published.items() if n.startswith(("stg_", "int_", "fct_"))})


# -- data tests ------------------------------------------------------------------------


@query
def dq_suite(spark, sf_dir):
    """The tests of single rows are counted while the tables are written."""
    watched = quality.Watched()
    tables = build_tables(events(spark, sf_dir), new_dir(spark, "tables"), watched=watched)
    return quality.run_suite(tables, watched=watched)


@query
def dq_damaged_events(spark, sf_dir):
    """The data tests of staged events over the events and damaged copies of them: repeated
    and missing ids, unknown values, missing attributes. Every kind of rule finds rows."""
    stg = written(events(spark, sf_dir), "stg_events")
    n = "bigint(event_id)"
    damaged = stg.selectExpr(
        "event_id", f"IF({n} % 2 = 0, user_id, NULL) AS user_id", f"IF({n} % 3 = 0, session_id, NULL) AS session_id",
        f"IF({n} % 5 = 0, 'unknown_step', event_type) AS event_type", "event_timestamp",
        f"CASE WHEN {n} % 7 = 0 THEN 'third_arm' WHEN {n} % 7 > 1 THEN variant END AS variant",
        f"CASE WHEN {n} % 11 = 0 THEN 'Billboard' WHEN {n} % 11 > 1 THEN acquisition_channel END "
        "AS acquisition_channel",
        f"IF({n} % 13 > 0, signup_date, NULL) AS signup_date", f"IF({n} % 17 = 0, 'watch', device) AS device",
        f"IF({n} % 19 > 0, ingested_at, NULL) AS ingested_at")
    nameless = stg.where(f"{n} % 23 = 0").selectExpr(*[
        f"CAST(NULL AS {kind}) AS {c}" if c in ("event_id", "event_type", "event_timestamp") else c
        for c, kind in stg.dtypes])
    whole = written(stg.unionByName(damaged).unionByName(nameless), "damaged_events")
    return quality.run_suite({"stg_events": whole})


@query
def dq_damaged_tables(spark, sf_dir):
    """All data tests over all tables, each followed by damaged copies of its rows: values outside
    their domain, whole segments leaving, more active users than a cohort has, the same rows
    again, and rows without any value. Every rule that can find rows finds some."""
    tables = build_tables(events(spark, sf_dir), new_dir(spark, "tables"))
    rules = quality.declared_rules()
    wrong = {"exit_percentage": F.lit(100.0), "newest_users": F.col("cohort_size") + 1}
    damaged = {}
    for model, df in tables.items():
        odd = {r.columns[0]: F.lit(9 if 0 in r.values else "odd") for r in rules if r.model == model and r.kind == "accepted_values"}
        again = {c: v for c, v in odd.items() if c == "grain"}
        flags = [c for c, kind in df.dtypes if kind == "boolean"]
        odd = {c: v for c, v in {**odd, **wrong}.items() if c in df.columns and c not in (*again, *flags)}
        copies = [df.select(*[new.get(c, F.col(c)).cast(kind).alias(c) for c, kind in df.dtypes]) for new in (odd, again)]
        empty = df.select(*[F.lit(None).cast(kind).alias(c) for c, kind in df.dtypes])
        damaged[model] = written(df.unionByName(copies[0]).unionByName(copies[1]).unionByName(empty), "damaged")
    return quality.run_suite(damaged)


@query
def event_order_check(spark, sf_dir):
    return quality.event_order_flags(events(spark, sf_dir)).agg(
        F.count_if("out_of_order").alias("out_of_order_sessions"), F.sum("events").alias("events_checked"))


@query
def user_attribute_check(spark, sf_dir):
    stg = events(spark, sf_dir)
    fixed = [SPEC.variant, SPEC.device, SPEC.channel, SPEC.signup]
    changing = quality.changing_attributes(stg, [*fixed, SPEC.event_type])
    return changing.agg(*[F.count_if(F.col(f"{c}_changes")).alias(f"{c}_changes")
                          for c in [*fixed, SPEC.event_type]])


@query
def repeated_step_check(spark, sf_dir):
    """Data tests over the events as they come, without the adapter's one step per type:
    accepted values and the reached-once rule do find violations here."""
    raw = sessionize(read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type"),
                     "user_id", "ts", GAP_HOURS)
    per_session = raw.groupBy("user_id", "session_no").agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )
    rules = [
        quality.Rule("raw_sessions", "accepted_values", ("views",), (0, 1)),
        quality.Rule("raw_sessions", "accepted_values", ("purchases",), (0, 1), "views = 0"),
        quality.Rule("raw_sessions", "unique", ("user_id",)),
        quality.Rule("raw_sessions", "unique_combination", ("user_id", "session_no")),
        quality.Rule("raw_sessions", "not_null", ("views",)),
    ]
    return quality.run_suite({"raw_sessions": per_session}, rules=rules)


# -- experiment ------------------------------------------------------------------------


@query
def arm_counts(spark, sf_dir):
    return experiment.arm_counts(sessions(spark, sf_dir))


@query
def srm_check(spark, sf_dir):
    return experiment.srm_check(sessions(spark, sf_dir))


@query
def covariate_contingency(spark, sf_dir):
    return experiment.contingency(sessions(spark, sf_dir), DEFAULT_EXPERIMENT.covariates)


@query
def covariate_balance(spark, sf_dir):
    return experiment.covariate_balance(sessions(spark, sf_dir))


@query
def hte_main_effect(spark, sf_dir):
    return experiment.hte_main_effect(sessions(spark, sf_dir))


@query
def hte_logit(spark, sf_dir):
    return experiment.hte_logit(sessions(spark, sf_dir))


@query
def hte_logit_fit(spark, sf_dir):
    """At the optimum a term's sessions are expected to convert as often as they did; these
    equations, one per term, fix the coefficients."""
    fitted = experiment.hte_logit(sessions(spark, sf_dir))
    return fitted.select("term", "sessions", "observed", F.round("expected", 4).alias("expected"), "converged")


# -- survival --------------------------------------------------------------------------


@query
def km_conversion(spark, sf_dir):
    return survival.conversion_curve(sessions(spark, sf_dir))


@query
def step_durations(spark, sf_dir):
    return survival.step_durations(transitions(spark, sf_dir), keep=[SPEC.session])


@query
def km_step_transitions(spark, sf_dir):
    return survival.step_curves(transitions(spark, sf_dir))


@query
def km_step_transitions_by_variant(spark, sf_dir):
    return survival.step_curves(transitions(spark, sf_dir), by_variant=True)


# -- segments --------------------------------------------------------------------------


def _features(spark, sf_dir):
    return segments.user_features(sessions(spark, sf_dir))


@query
def user_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def user_features_scaled(spark, sf_dir):
    features = written(_features(spark, sf_dir), "user_features")  # read twice: statistics, rows
    scaled = segments.standardize(features, segments.FEATURES)
    return scaled.select(SPEC.user, *[F.round(c, 6).alias(c) for c in segments.FEATURES])


@query
def kmeans_sweep(spark, sf_dir):
    return segments.kmeans_sweep(_features(spark, sf_dir), SPEC.user)[0]


@query
def kmeans_segments(spark, sf_dir):
    return segments.segment_profile(segments.kmeans_sweep(_features(spark, sf_dir), SPEC.user)[1], "cluster")


@query
def kmeans_check(spark, sf_dir):
    return segments.kmeans_check(_features(spark, sf_dir), SPEC.user)


@query
def silhouette_all(spark, sf_dir):
    """Every embedding, not a sample."""
    return segments.silhouette_all(read(spark, sf_dir, "embeddings"), "embedding", ["label"])


@query
def silhouette_sampled(spark, sf_dir):
    return segments.silhouette_sampled(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", ["label"])


@query
def segment_profile(spark, sf_dir):
    return segments.segment_profile(_features(spark, sf_dir), "max_funnel_depth")


# -- population ------------------------------------------------------------------------


def _chapman(spark, sf_dir):
    """Captures are hours of the log: each hour is a unit that can be read alone."""
    hours = read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd-HH").alias("hour"), "user_id")
    return population.chapman_estimate(hours, "hour", "user_id")


@query
def chapman_users(spark, sf_dir):
    return _chapman(spark, sf_dir)


@query
def chapman_files(spark, sf_dir):
    return population.chapman_from_files(spark, landed(spark, sf_dir))


@query
def chapman_folders(spark, sf_dir):
    """Date folders of the landing as units, at most five to a capture."""
    return population.chapman_from_folders(spark, landed(spark, sf_dir), 5)


@query
def chapman_customers(spark, sf_dir):
    """Customers seen on two random sets of 200 order dates."""
    return population.chapman_estimate(read(spark, sf_dir, "orders"), "o_orderdate", "o_custkey", 200)


@query
def power_plan(spark, sf_dir):
    return population.power_plan(sessions(spark, sf_dir), [SPEC.device, SPEC.channel])


@query
def funnel_reach(spark, sf_dir):
    return population.funnel_reach(sessions(spark, sf_dir), [SPEC.variant, SPEC.device])


@query
def sessions_per_user(spark, sf_dir):
    return population.sessions_per_user(sessions(spark, sf_dir))


@query
def population_verdict(spark, sf_dir):
    return population.population_verdict(sessions(spark, sf_dir), _chapman(spark, sf_dir))


# -- streaming -------------------------------------------------------------------------


@query
def stream_ingest(spark, sf_dir):
    out, state = new_dir(spark, "stream-landing"), new_dir(spark, "stream-state")
    rows = ingest.stream_landing(ingest.stream_files(spark, landed(spark, sf_dir)))
    ingest.drain(ingest.append_table(rows, out, state, every=None))
    return typed(stg_events(spark.read.parquet(out)))


@query
def stream_notices(spark, sf_dir):
    """Landing by messages: every file is named twice, in different batches, beside messages of
    deleted objects and of other keys."""
    log, out, state = (new_dir(spark, n) for n in ("notices", "noticed", "stream-state"))
    root = landed(spark, sf_dir)
    files = land.list_files(spark, root).select(F.expr("substring_index(source_file, '/', -4)").alias("key"), "length")

    def messages(event: str, key: Column) -> DataFrame:
        thing = F.struct(F.struct(F.lit("clicks").alias("name")).alias("bucket"),
                         F.struct(F.url_encode(key).alias("key"), F.col("length").alias("size")).alias("object"))
        record = F.struct(F.lit(event).alias("eventName"), thing.alias("s3"))
        return files.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value"))

    created = messages("ObjectCreated:Put", F.col("key"))
    others = messages("ObjectRemoved:Delete", F.col("key")).unionAll(messages("ObjectCreated:Copy", F.concat("key", F.lit(".bak"))))
    created.unionAll(others).repartition(4).write.text(log)
    created.repartition(3).write.mode("append").text(log)
    named = notices.named_files(notices.stream_notices(spark, log, max_files=2), {"clicks": root})
    ingest.drain(notices.land_noticed(named, out, state, every=None, buckets=16, max_parts=3))
    return typed(stg_events(notices.noticed_rows(spark, out)))


@query
def stream_flush_counts(spark, sf_dir):
    """Counts kept by a listener over two runs: one ends in a failing batch, the next lands it."""
    out, state, kept = (new_dir(spark, n) for n in ("flushed", "stream-state", "flush-counts"))
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, landed(spark, sf_dir), max_files=8)))
    failed = []

    def flush(batch: DataFrame, number: int) -> None:
        if number == 2 and not failed:
            failed.append(number)
            raise RuntimeError("a flush that fails once")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    listener = scounts.FlushCounts(spark, kept)
    spark.streams.addListener(listener)
    try:
        for _ in range(2):
            writer = rows.writeStream.foreachBatch(flush).option("checkpointLocation", state)
            running = writer.trigger(availableNow=True).start()
            try:
                running.awaitTermination()
            except StreamingQueryException:
                pass
            listener.wait(running)
    finally:
        spark.streams.removeListener(listener)
    flushed = spark.read.parquet(out)
    return scounts.flush_counts(spark, kept).select(
        "runs", F.col("rows").alias("landed_rows"), F.col("failures").alias("failed_flushes"),
        (F.col("batches") == flushed.select(F.count_distinct("batch")).scalar()).alias("every_batch_counted"))


@query
def stream_ndjson(spark, sf_dir):
    """Events back out to dated JSON files by a stream, then read in bulk."""
    out, state = new_dir(spark, "stream-ndjson"), new_dir(spark, "stream-state")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, landed(spark, sf_dir))))
    ingest.drain(ingest.append_ndjson(land.payload(rows, EXPERIMENT_ID), out, state, every=None))
    return typed(stg_events(land.read_landing(spark, out)))


@query
def stream_dedup(spark, sf_dir):
    """A bulk load and an auto-ingest over the same files land every event twice."""
    out, state = new_dir(spark, "stream-dedup"), new_dir(spark, "stream-state")
    files = landed(spark, sf_dir)
    twice = ingest.stream_files(spark, files).unionAll(ingest.stream_files(spark, files))
    once = sdedup.dedup_stream(stg_events(ingest.stream_landing(twice)))
    ingest.drain(ingest.append_table(once, out, state, every=None))
    return typed(spark.read.parquet(out))


@query
def stream_dedup_for_good(spark, sf_dir):
    """Every event landed twice, the copies batches apart; ids are kept on disk, not in state."""
    files, out, state = (new_dir(spark, n) for n in ("landing-twice", "stream-dedup", "stream-state"))
    body = land.payload(events(spark, sf_dir), EXPERIMENT_ID)
    for _ in range(2):
        land.write_ndjson(body, files, mode="append")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, files, max_files=25)))
    ingest.drain(sdedup.dedup_for_good(rows, out, state, every=None, buckets=16))
    return typed(sdedup.deduplicated(spark, out))


@query
def stream_kept_sessions(spark, sf_dir):
    """Sessions by key over several batches: buckets fold, sessions that go on past midnight meet."""
    out, state = new_dir(spark, "kept-sessions"), new_dir(spark, "stream-state")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, landed(spark, sf_dir), max_files=8)))
    ingest.drain(ssessions.keep_sessions(rows, out, state, every=None, buckets=16, max_parts=3))
    return ssessions.kept_sessions(spark, out).drop(*[s.first_ts_col for s in SPEC.steps])


@query
def stream_retention(spark, sf_dir):
    """Cohorts by delta over several batches of files."""
    out, state = new_dir(spark, "retention"), new_dir(spark, "stream-state")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, landed(spark, sf_dir), max_files=12)))
    ingest.drain(sretention.stream_retention(rows, out, state, every=None, buckets=16))
    return sretention.RetentionTable(spark, out, buckets=16).read()


@query
def stream_sessions(spark, sf_dir):
    out, state = new_dir(spark, "stream-sessions"), new_dir(spark, "stream-state")
    rows = stg_events(ingest.stream_landing(ingest.stream_files(spark, landed(spark, sf_dir))))
    ingest.drain(ssessions.stream_session_partials(rows, out, state, every=None))
    return ssessions.streamed_sessions(spark, out).drop(*[s.first_ts_col for s in SPEC.steps])


# -- the same operators on other tables ------------------------------------------------


@query
def cohort_retention_orders(spark, sf_dir):
    """Customers by first order date and market segment, active when they order."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    firsts = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    # Repeat orders on one day change nothing: cut them before the joins.
    activity = orders.distinct().join(firsts, "o_custkey").join(customers, "o_custkey")
    return marts.user_retention(activity, FunnelSpec(user="o_custkey"), ["c_mktsegment"],
                                signup="first_order", active_at="o_orderdate")


@query
def dropoff_orders(spark, sf_dir):
    """Priority of each customer's last order, as a share within the market segment."""
    spec = FunnelSpec(session="c_custkey", event_id="o_orderkey", event_type="o_orderpriority",
                      event_ts="o_orderdate")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority", "o_orderdate")
    last = marts.session_exits(orders, spec, [])
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return marts.exit_shares(last.join(customers, "c_custkey"), spec, ["c_mktsegment"], ["c_mktsegment"])
