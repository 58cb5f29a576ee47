"""The registered queries: every operator over the whole benchmark tables.

Results are put in portable types (numbers as BIGINT or DOUBLE, dates as midnight timestamps), so
another engine's answer can be compared with them value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import (
    aggregates, cost, extract, metrics, quality, reports, runlog, search, upsert, views,
)
from lectern.plans import jobs
from lectern.plans.constraints import Constraints
from lectern.plans.rollups import Rollups
from lectern.schemas import DQ_ISSUES_SCHEMA, ENTITIES, GRADE_BANDS, RUN_EVENT_SCHEMA
from lectern.session import scratch_dir, use_light_shuffles, use_utc
from lectern.sources import landing
from lectern.sources.changes import Consumer
from lectern.sources.store import Lake
from lectern.sources.testbed import AS_OF, NOW, ORDERS_AS_OF, Testbed
from lectern.streaming import streams

LATER = datetime(2024, 2, 2, 6, 0, 0)
ALERT_NOW = datetime(2024, 1, 30, 23, 30, 0)
SNAPSHOT_DAY = date(2024, 1, 30)

# For each entity: the part already stored, the part a feed sends again, and what the feed changed.
STORED = {
    "students": "major <> 'AUTOMOBILE'",
    "courses": "max_enrollment <= 200",
    "assignments": "p_size <= 40",
    "enrollments": "enrolled_at < TIMESTAMP '2000-01-01 00:00:00'",
    "submissions": "enrolled_at < TIMESTAMP '2000-01-01 00:00:00'",
    "activity_logs": "activity_timestamp < TIMESTAMP '2024-01-20 00:00:00'",
}
RESENT = {
    "students": "major <> 'MACHINERY'",
    "courses": "max_enrollment > 50",
    "assignments": "p_size > 10",
    "enrollments": "enrolled_at >= TIMESTAMP '1997-01-01 00:00:00'",
    "submissions": "enrolled_at >= TIMESTAMP '1997-01-01 00:00:00'",
    "activity_logs": "activity_timestamp >= TIMESTAMP '2024-01-10 00:00:00'",
}
CHANGES = {
    "students": {"gpa": "gpa - CAST(0.01 AS DECIMAL(3,2))", "enrollment_status": "'Active'",
                 "enrollment_date": "enrollment_date + INTERVAL '1' DAY"},
    "courses": {"max_enrollment": "max_enrollment + 1", "course_name": "upper(course_name)",
                "delivery_mode": "'Online'"},
    "assignments": {"assignment_name": "upper(assignment_name)", "weight": "weight + 1",
                    "due_date": "due_date + INTERVAL '1' DAY", "assignment_type": "'Changed'"},
    "enrollments": {"enrollment_state": "'completed'", "final_score": "final_score - 1",
                    "completed_at": "enrolled_at + INTERVAL '100' DAY", "enrollment_type": "'Changed'"},
    "submissions": {"score": "score + 1", "percentage": "percentage - 1", "late_flag": "NOT late_flag",
                    "graded_at": "graded_at + INTERVAL '1' DAY", "points_possible": "points_possible + 5"},
    "activity_logs": {"duration_seconds": "duration_seconds + 1"},
}
# Which documents a search feed sends again, and which of them changed or lost their text.
AGAIN = {"sent": "activity_type <> 'PageView'", "changed": "device_type = 'Mobile'", "emptied": "coalesce(device_type = 'Tablet', false)"}
DEFAULT_NAMES = (
    "CASE warehouse_name WHEN 'DEMO_CLICK_WH' THEN 'DEMO_INGESTION_WH' WHEN 'DEMO_VIEW_WH' THEN 'DEMO_TRANSFORM_WH' "
    "ELSE 'DEMO_TASK_WH' END"
)
HELPERS = {"assignments": ("p_size",), "submissions": ("enrolled_at",)}
RAW_STATUS = {
    "students": "CASE major WHEN 'HOUSEHOLD' THEN 'PROCESSED' WHEN 'FURNITURE' THEN 'ERROR' ELSE 'PENDING' END",
    "courses": "CASE WHEN course_level = 'Graduate' THEN 'PROCESSED' ELSE 'PENDING' END",
    "assignments": "CASE WHEN assignment_type = 'Quiz' THEN 'ERROR' ELSE 'PENDING' END",
    "enrollments": "CASE enrollment_state WHEN 'completed' THEN 'PROCESSED' ELSE 'PENDING' END",
    "submissions": "CASE WHEN grade = 'F' THEN 'PROCESSED' ELSE 'PENDING' END",
    "activity_logs": "CASE WHEN activity_type = 'Quiz' THEN 'ERROR' ELSE 'PENDING' END",
}
TORN = "CASE WHEN payload LIKE '%\"activity_type\":\"Quiz\"%' THEN substring(payload, 1, 40) ELSE payload END"

# Queries whose time goes into joins of state and changes more than into what they store.
HASHED = ("job_incremental", "job_incremental_courses", "job_constraints")

Query = Callable[[Testbed], DataFrame]
_QUERIES: dict[str, Query] = {}


def register(name: str):
    def add(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn
    return add


def portable(df: DataFrame) -> DataFrame:
    def target(kind: str) -> str:
        if kind.startswith("decimal"):
            return "double"
        return {"int": "bigint", "date": "timestamp_ntz", "timestamp": "timestamp_ntz"}.get(kind, kind)

    return df.selectExpr(*[
        f"`{c}`" if target(t) == t else f"CAST(`{c}` AS {target(t)}) AS `{c}`" for c, t in df.dtypes
    ])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, fn: Query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_light_shuffles(use_utc(spark), name.startswith(("job_", "stream_")), name in HASHED)
            return portable(fn(Testbed(spark, sf_dir)))
        return run
    return {name: bind(name, fn) for name, fn in _QUERIES.items()}


# --- landing and extraction -------------------------------------------------------------------

@register("land_raw")
def _(tb):
    payloads = tb.raw("students").select("payload")
    key = F.get_json_object("payload", "$.student_id")
    landed = extract.land_raw(payloads, now=NOW, file_name="students.json", raw_id=F.concat(F.lit("raw-"), key))
    return landed.select("raw_id", "source_system", "file_name", "ingested_at", "processing_status",
                         key.alias("student_id"))


def _extractor(entity: str) -> Query:
    def run(tb: Testbed) -> DataFrame:
        raw = tb.raw(entity, status=RAW_STATUS[entity])
        return extract.extract(raw, entity)
    return run


for _entity in ENTITIES:
    register(f"extract_{_entity}")(_extractor(_entity))


def _raws(tb: Testbed) -> dict[str, DataFrame]:
    return {e: tb.raw(e, status=RAW_STATUS[e]) for e in ENTITIES}


@register("validate_raw_json")
def _(tb):
    raws = _raws(tb)
    raws["activity_logs"] = raws["activity_logs"].withColumn("payload", F.expr(TORN))
    return extract.validate_raw_json(raws)


@register("rejected_rows")
def _(tb):
    torn = tb.raw("activity_logs").withColumn("payload", F.expr(TORN))
    return extract.rejected(torn, "activity_logs").select("raw_id", "reason")


@register("raw_preview")
def _(tb):
    return extract.preview(tb.raw("students"), "students", ["student_id", "first_name", "last_name", "major", "gpa"])


# --- upserts and row state ----------------------------------------------------------------------

def _dims(tb: Testbed, *names: str) -> dict[str, DataFrame]:
    return {n: tb.curated(n) for n in names}


def _lookup(tb: Testbed, entity: str, fact: DataFrame, *, once: bool = False) -> DataFrame:
    """Looked-up keys; ``once`` makes sure that a row of the fact stays one, however often the dimension has its id."""
    dims = _dims(tb, *[d for d, _ in ENTITIES[entity].lookups.values()])
    if once:
        dims = {n: df.groupBy(ENTITIES[n].key).agg(F.max(ENTITIES[n].surrogate).alias(ENTITIES[n].surrogate)) for n, df in dims.items()}
    return upsert.lookup_keys(fact, entity, dims)


def stored_target(tb: Testbed, entity: str) -> DataFrame:
    """The stored part with every curated column; fact keys are looked up, fact numbers are still open."""
    spec = ENTITIES[entity]
    df = tb.curated(entity, *HELPERS.get(entity, ())).where(STORED[entity])
    if spec.lookups:
        df = _lookup(tb, entity, df)
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in spec.columns])


def resent_raw(tb: Testbed, entity: str) -> DataFrame:
    """The feed: changed rows, and before them a stale copy of each that the later one replaces."""
    return tb.raw(entity, changes=CHANGES[entity], where=RESENT[entity], helpers=HELPERS.get(entity, ()),
                  feed="second", ingested_at=LATER, stale=("first", NOW))


def resent(tb: Testbed, entity: str) -> DataFrame:
    """The feed's last row per key; a row travels to its dimensions when the copies before it are gone."""
    spec = ENTITIES[entity]
    typed = extract.extract(resent_raw(tb, entity), entity, keep=upsert.BATCH_ORDER)
    if not spec.lookups:
        return typed
    last = upsert.latest_per_key(typed, [spec.key], keep_order=False)
    return _lookup(tb, entity, last, once=True)


def _upserter(entity: str, profile: str = "full") -> Query:
    def run(tb: Testbed) -> DataFrame:
        spec = ENTITIES[entity]
        return upsert.merge_entity(spec, stored_target(tb, entity), resent(tb, entity), now=LATER, profile=profile)
    return run


for _entity, _spec in ENTITIES.items():
    if _spec.updates:
        register(f"upsert_{_entity}")(_upserter(_entity))
register("upsert_enrollments_narrow")(_upserter("enrollments", "sql"))
register("upsert_submissions_narrow")(_upserter("submissions", "sql"))
register("insert_new_activity")(_upserter("activity_logs"))


@register("append_activity")
def _(tb):
    source = extract.extract(tb.raw("activity_logs", where=RESENT["activity_logs"]), "activity_logs")
    return upsert.append(tb.activity().where(STORED["activity_logs"]).drop("created_at"), source)


@register("backfill_keys")
def _(tb):
    early = {"students": tb.students().where(STORED["students"]), "courses": tb.courses().where(STORED["courses"])}
    facts = upsert.lookup_keys(tb.enrollments(), "enrollments", early)
    filled = upsert.backfill_keys(facts, "enrollments", _dims(tb, "students", "courses"))
    return filled.select("enrollment_id", "student_id", "course_id", "student_key", "course_key")


@register("assigned_keys")
def _(tb):
    merged = _upserter("students")(tb)
    numbered = upsert.assign_keys(merged, "student_key", stored_target(tb, "students"))
    return numbered.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("student_key").alias("key_count"),
                        F.count_if(F.col("student_key").isNull()).alias("open_keys"))


@register("pending_counts")
def _(tb):
    return upsert.pending_counts(_raws(tb))


@register("mark_processed")
def _(tb):
    raw = tb.raw("enrollments", status=RAW_STATUS["enrollments"])
    return upsert.mark_processed(raw).select("raw_id", "processing_status")


@register("mark_bound_batch")
def _(tb):
    raw = tb.raw("enrollments", status=RAW_STATUS["enrollments"])
    batch = tb.raw("enrollments", where=STORED["enrollments"]).select("raw_id")
    return upsert.mark_processed(raw, batch).select("raw_id", "processing_status")


@register("mark_error")
def _(tb):
    torn = tb.raw("activity_logs").withColumn("payload", F.expr(TORN))
    return upsert.mark_error(torn, extract.rejected(torn, "activity_logs")).select("raw_id", "processing_status")


@register("touch_active_students")
def _(tb):
    recent = F.when(F.col("major") == "MACHINERY", F.lit(LATER)).otherwise(F.lit(NOW)).cast("timestamp_ntz")
    dim = tb.students().withColumns({"updated_at": recent, "is_current": F.lit(False)})
    return upsert.touch_active_students(dim, now=LATER).select("student_id", "is_current", "updated_at")


@register("refresh_current_courses")
def _(tb):
    dim = tb.courses().withColumn("is_current", F.when(F.col("department") != "PROMO", F.col("is_current")))
    return upsert.refresh_current_courses(dim, now=LATER).select("course_id", "is_current", "updated_at")


# --- rollups --------------------------------------------------------------------------------------

def performance(tb: Testbed, compat: bool = False) -> DataFrame:
    return aggregates.student_course_performance(
        tb.students(), tb.enrollments(), tb.courses(), tb.assignments(), tb.submissions(), tb.activity(),
        now=NOW, compat=compat,
    )


def course_rollup(tb: Testbed) -> DataFrame:
    return aggregates.course_analytics(tb.courses(), tb.enrollments(), tb.activity(), now=NOW)


def _flat_grades(df: DataFrame) -> DataFrame:
    flat = [F.col(f"grade_distribution.{b}").alias(f"grade_{b.lower()}") for b in GRADE_BANDS]
    return df.select("*", *flat).drop("grade_distribution")


register("student_course_performance")(performance)
register("student_course_performance_compat")(lambda tb: performance(tb, compat=True))
register("course_analytics")(lambda tb: _flat_grades(course_rollup(tb)))
register("student_risk")(lambda tb: aggregates.student_risk(performance(tb)))
register("grade_distribution")(lambda tb: _flat_grades(aggregates.grade_distribution(tb.enrollments(), "course_id")))
register("engagement_minutes")(lambda tb: aggregates.engagement_minutes(tb.activity()))

# --- quality and audit ----------------------------------------------------------------------------

def _twice_landed(tb: Testbed) -> DataFrame:
    """Students as landed: the stored part and the feed without the stale copies, so some ids come twice."""
    again = tb.raw("students", changes=CHANGES["students"], where=RESENT["students"])
    return extract.extract(tb.raw("students", where=STORED["students"]).unionByName(again), "students")


register("dq_orphaned_enrollments")(lambda tb: quality.orphaned_enrollments(tb.enrollments(), tb.students()))


@register("dq_duplicate_students")
def _(tb):
    return quality.duplicate_students(_twice_landed(tb)).select("check_name", "record_id")


@register("dq_invalid_gpa")
def _(tb):
    return quality.invalid_gpa(tb.students()).select(
        "check_name", "record_id", F.get_json_object("details", "$.gpa").cast("double").alias("gpa"))


@register("dq_report")
def _(tb):
    return quality.dq_report(quality.dq_issues(tb.enrollments(), tb.students()), now=NOW)


@register("dq_thresholds")
def _(tb):
    return quality.dq_thresholds(tb.enrollments(), [
        quality.Check("no_final_score", "count_if(final_score IS NULL)", 100),
        quality.Check("score_out_of_range", "count_if(final_score < 0 OR final_score > 100)"),
        quality.Check("no_student", "count_if(student_id IS NULL)"),
    ]).drop("error")


@register("linkage_check")
def _(tb):
    return quality.linkage_check(_lookup(tb, "enrollments", tb.enrollments()))


register("constraint_report")(lambda tb: quality.constraint_report({e: tb.curated(e) for e in ENTITIES}))
register("table_counts")(lambda tb: quality.table_counts({e: tb.curated(e) for e in ENTITIES}))
register("raw_table_counts")(lambda tb: quality.table_counts({f"raw_{e}": tb.raw(e) for e in ENTITIES}))
register("data_summary")(lambda tb: quality.data_summary(tb.spark, {e: tb.curated(e) for e in ENTITIES}))


@register("submission_pairs")
def _(tb):
    return quality.submission_pairs(tb.raw("enrollments"), tb.raw("assignments", status=RAW_STATUS["assignments"]))


register("etl_run_log")(lambda tb: runlog.latest_runs(tb.run_events()).drop("metadata"))
register("job_status")(lambda tb: runlog.job_status(runlog.latest_runs(tb.run_events())))
register("recent_runs")(lambda tb: runlog.recent_runs(runlog.latest_runs(tb.run_events())).drop("metadata"))
register("service_log_parse")(lambda tb: runlog.service_log_parse(tb.metering("service_logs")))

# --- cost -----------------------------------------------------------------------------------------

register("usage_hourly")(lambda tb: cost.usage_hourly(tb.metering("warehouse_metering"), as_of=AS_OF))
register("warehouse_daily_costs")(
    lambda tb: cost.warehouse_daily_costs(tb.metering("warehouse_metering"), tb.rules(), as_of=AS_OF))
register("monthly_trends")(lambda tb: cost.monthly_trends(tb.metering("warehouse_metering_long"), as_of=ORDERS_AS_OF))
register("pool_usage_hourly")(lambda tb: cost.pool_usage_hourly(tb.metering("container_history"), as_of=AS_OF))
register("container_daily_costs")(
    lambda tb: cost.container_daily_costs(tb.metering("container_history"), tb.rules(), as_of=AS_OF))
register("task_costs")(lambda tb: cost.task_costs(tb.metering("task_history"), as_of=AS_OF))
register("task_failures")(lambda tb: cost.task_failures(tb.metering("task_history"), as_of=AS_OF))
register("storage_costs")(lambda tb: cost.storage_costs(tb.metering("database_storage"), as_of=AS_OF))
register("table_storage")(lambda tb: cost.table_storage(tb.metering("table_storage")))
register("top_tables")(lambda tb: cost.top_tables(tb.metering("table_storage")))


@register("cost_default_rules")
def _(tb):
    """Daily cost of the resources that the default rules name, a part of all metered use each."""
    named = tb.metering("warehouse_metering").withColumn("warehouse_name", F.expr(DEFAULT_NAMES))
    return cost.warehouse_daily_costs(named, cost.default_rules(tb.spark), as_of=AS_OF)


@register("cost_dashboard")
def _(tb):
    return cost.cost_dashboard(tb.metering("warehouse_metering"), tb.metering("container_history"),
                               tb.metering("task_history"), tb.rules(), as_of=AS_OF)


_ALERT_COLS = ["alert_type", "resource_type", "resource_name", "period", "threshold_value", "current_value",
               "alert_message", "alert_timestamp", "acknowledged"]
register("alert_daily_threshold")(
    lambda tb: cost.alert_daily_threshold(tb.metering("warehouse_metering"), now=ALERT_NOW).select(_ALERT_COLS))
register("alert_hourly_spike")(
    lambda tb: cost.alert_hourly_spike(tb.metering("warehouse_metering"), now=ALERT_NOW).select(_ALERT_COLS))


@register("open_alerts")
def _(tb):
    alerts = cost.cost_alerts(tb.metering("warehouse_metering"), now=ALERT_NOW)
    seen = F.col("resource_name") == "DEMO_VIEW_WH"
    return cost.open_alerts(alerts.withColumn("acknowledged", seen)).select(_ALERT_COLS)


@register("new_alerts")
def _(tb):
    usage = tb.metering("warehouse_metering")
    logged = cost.alert_daily_threshold(usage, now=ALERT_NOW)
    return cost.new_alerts(cost.cost_alerts(usage, now=ALERT_NOW), logged).select(_ALERT_COLS)


register("snapshot_warehouse")(
    lambda tb: cost.snapshot_warehouse(tb.metering("warehouse_metering"), tb.rules(), day=SNAPSHOT_DAY))
register("snapshot_container")(
    lambda tb: cost.snapshot_container(tb.metering("container_history"), tb.rules(), day=SNAPSHOT_DAY))


def _snapshots(tb: Testbed) -> DataFrame:
    return cost.snapshots_from_usage(tb.metering("warehouse_metering"), tb.metering("container_history"), tb.rules())


register("cost_summary_7d")(lambda tb: cost.cost_summary(_snapshots(tb), as_of=AS_OF))
register("cost_by_project")(lambda tb: cost.cost_by_project(_snapshots(tb), as_of=AS_OF))
register("service_metrics")(lambda tb: cost.service_metrics(tb.metering("serverless_history")))

# --- base views, metrics and reports ----------------------------------------------------------------

def _enrolled(tb: Testbed) -> DataFrame:
    return views.enrollments_base(tb.enrollments(), tb.students(), tb.courses())


def _handed_in(tb: Testbed) -> DataFrame:
    return views.submissions_base(tb.submissions(), tb.assignments(), tb.students())


def _performed(tb: Testbed) -> DataFrame:
    return views.performance_base(performance(tb), tb.students(), tb.courses())


register("students_base")(lambda tb: views.students_base(tb.students()).drop("created_at", "updated_at"))
register("courses_base")(lambda tb: views.courses_base(tb.courses()).drop("created_at"))
register("enrollments_base")(lambda tb: _enrolled(tb).drop("created_at"))
register("submissions_base")(lambda tb: _handed_in(tb).drop("created_at"))
register("performance_base")(lambda tb: _performed(tb).drop("calculated_at"))


@register("metrics_student")
def _(tb):
    return metrics.metric_query(views.students_base(tb.students()), metrics.STUDENT_MODEL,
                                metrics.STUDENT_MODEL.metrics, ["major", "academic_standing"])


@register("metrics_course")
def _(tb):
    return metrics.metric_query(views.courses_base(tb.courses()), metrics.COURSE_MODEL,
                                metrics.COURSE_MODEL.metrics, ["department", "term"])


@register("metrics_enrollment")
def _(tb):
    return metrics.metric_query(_enrolled(tb), metrics.ENROLLMENT_MODEL, metrics.ENROLLMENT_MODEL.metrics,
                                ["term", "department", "grade_category"], where="enrollment_status <> 'dropped'")


@register("metrics_submission")
def _(tb):
    return metrics.metric_query(_handed_in(tb), metrics.SUBMISSION_MODEL, metrics.SUBMISSION_MODEL.metrics,
                                ["assignment_type", "score_category", "student_major"])


@register("metrics_performance")
def _(tb):
    return metrics.metric_query(_performed(tb), metrics.PERFORMANCE_MODEL, metrics.PERFORMANCE_MODEL.metrics,
                                ["department", "term", "classification"])


@register("metrics_runtime")
def _(tb):
    model = metrics.STUDENT_MODEL.with_metric("at_risk_count", "count_if(gpa < 2.0)").with_dimension(
        "academic_standing",
        "CASE WHEN gpa >= 3.5 THEN 'Dean''s List' WHEN gpa >= 2.0 THEN 'Good Standing' ELSE 'Academic Probation' END",
    )
    return metrics.metric_query(views.students_base(tb.students()), model, ["total_students", "at_risk_count"],
                                ["academic_standing", "classification"])


@register("metrics_facts")
def _(tb):
    return metrics.fact_query(views.courses_base(tb.courses()), metrics.COURSE_MODEL, ["course_credits", "max_seats"],
                              ["course_id", "instructor"])


register("enrollment_detail")(lambda tb: reports.enrollment_detail(tb.enrollments(), tb.students(), tb.courses()))
register("performance_by_major")(lambda tb: reports.performance_by_major(tb.students(), performance(tb)))
register("course_report")(lambda tb: reports.course_report(course_rollup(tb), tb.courses()))
register("at_risk_students")(lambda tb: reports.at_risk_students(tb.students(), performance(tb)))
register("top_courses")(lambda tb: reports.top_courses(tb.enrollments(), tb.courses()))
register("enrollment_sample")(lambda tb: reports.enrollment_sample(tb.enrollments(), tb.courses()))
register("students_by_major")(lambda tb: reports.students_by_major(views.students_base(tb.students())))
register("courses_by_department")(lambda tb: reports.courses_by_department(views.courses_base(tb.courses())))
register("enrollments_by_term")(lambda tb: reports.enrollments_by_term(_enrolled(tb)))
register("submissions_by_type")(lambda tb: reports.submissions_by_type(_handed_in(tb)))
register("performance_by_dept")(lambda tb: reports.performance_by_dept(_performed(tb)))
register("gpa_by_major")(lambda tb: reports.gpa_by_major(views.students_base(tb.students())))
register("students_on_probation")(lambda tb: reports.students_on_probation(views.students_base(tb.students())))
register("most_active_instructors")(lambda tb: reports.most_active_instructors(views.courses_base(tb.courses())))
register("late_rate_by_type")(lambda tb: reports.late_rate_by_type(_handed_in(tb)))
register("highest_enrollment")(lambda tb: reports.highest_enrollment(_enrolled(tb)))
register("completion_by_department")(lambda tb: reports.completion_by_department(_enrolled(tb)))
register("enrollment_by_classification")(lambda tb: reports.enrollment_by_classification(_enrolled(tb)))
register("term_trend")(lambda tb: reports.term_trend(_enrolled(tb)))
register("dropout_rate")(lambda tb: reports.dropout_rate(_enrolled(tb)))
register("top_students_by_department")(lambda tb: reports.top_students_by_department(_enrolled(tb)))
register("pass_rate")(lambda tb: reports.pass_rate(_enrolled(tb)))

# --- search -----------------------------------------------------------------------------------------

register("activity_search_source")(lambda tb: search.activity_search_source(tb.activity()))
register("course_search_source")(lambda tb: search.course_search_source(tb.courses()))
register("student_search_source")(lambda tb: search.student_search_source(tb.students()))


def _questions(df: DataFrame, *columns: str) -> DataFrame:
    """One question per distinct combination of the columns."""
    text = F.concat_ws(" ", *columns)
    return df.select(text.alias("query_id"), text.alias("query")).distinct()


def _stored(tb: Testbed, index: search.Index, corpus: search.Corpus, *, blocks: bool = False) -> search.Index:
    """The index as a search job finds it: written once and read back."""
    path = scratch_dir(tb.spark, "index")
    search.save_index(index, path, blocks=blocks)
    return search.load_index(tb.spark, path, corpus, blocks=blocks)


@register("search_students")
def _(tb):
    source, corpus = search.student_search_source(tb.students()), search.STUDENT_CORPUS
    return search.search(_stored(tb, search.build_index(source, corpus), corpus),
                         _questions(source, "major", "classification"))


@register("search_courses")
def _(tb):
    source, corpus = search.course_search_source(tb.courses()), search.COURSE_CORPUS
    return search.search(_stored(tb, search.build_index(source, corpus), corpus),
                         _questions(source, "department", "delivery_mode"), where={"term": ["Fall 2024"]})


@register("search_activity")
def _(tb):
    source, corpus = search.activity_search_source(tb.activity()), search.ACTIVITY_CORPUS
    return search.search(_stored(tb, search.build_index(source, corpus), corpus),
                         _questions(source, "activity_type", "device_type"))


@register("search_pruned")
def _(tb):
    """The answers of ``search_activity`` from an index with blocks, of which those that cannot matter stay unread."""
    source, corpus = search.activity_search_source(tb.activity()), search.ACTIVITY_CORPUS
    return search.search(_stored(tb, search.build_index(source, corpus), corpus, blocks=True),
                         _questions(source, "activity_type", "device_type"))


@register("search_refreshed")
def _(tb):
    corpus = search.COURSE_CORPUS
    old = search.build_index(search.course_search_source(tb.courses().where(STORED["courses"])), corpus)
    changed = tb.courses().where(RESENT["courses"]).withColumn("course_name", F.concat("course_name", F.lit(" advanced")))
    new = search.build_index(search.course_search_source(changed), corpus)
    refreshed = search.refresh_index(_stored(tb, old, corpus), _stored(tb, new, corpus))
    return search.search(refreshed, _questions(tb.courses(), "department", "course_name"))


# --- jobs and streams -------------------------------------------------------------------------------

def _lake(tb: Testbed, name: str) -> Lake:
    return Lake(tb.spark, scratch_dir(tb.spark, name))


@register("job_full_refresh")
def _(tb):
    lake = _lake(tb, "refresh")
    jobs.reset(lake)
    for entity in ENTITIES:
        landing.land_envelopes(lake, entity, tb.raw(entity), "first")
    result = jobs.run_job(tb.spark, "FULL_REFRESH", root=lake.root, now=NOW)
    return result.select("name", "status", "records_processed").join(
        jobs.summary(lake).withColumn("name", F.lit("FULL_REFRESH")), "name")


@register("job_merge_submissions")
def _(tb):
    lake = _lake(tb, "merge")
    for entity in ("students", "assignments"):
        landing.land_envelopes(lake, entity, tb.raw(entity), "first")
        jobs.process_entity(lake, entity, now=NOW)
    old = tb.raw("submissions", where=STORED["submissions"], helpers=HELPERS["submissions"])
    for batch, raw, now in (("first", old, NOW), ("second", resent_raw(tb, "submissions"), LATER)):
        landing.land_envelopes(lake, "submissions", raw, batch)
        jobs.process_entity(lake, "submissions", now=now)
    return jobs.curated(lake, "submissions").select(
        "submission_id", "student_id", "assignment_id", "submitted_at", "graded_at", "score", "points_possible",
        "percentage", "late_flag", "updated_at")


def _landed(tb: Testbed, lake: Lake, entity: str, batch: str, now: datetime, **part) -> None:
    landing.land_envelopes(lake, entity, tb.raw(entity, helpers=HELPERS.get(entity, ()), ingested_at=now, **part), batch)
    jobs.process_entity(lake, entity, now=now)


@register("stream_changes_enrollments")
def _(tb):
    """What the second of two batches changed, as a consumer gets it: new rows, and changed rows before and after."""
    lake, spec, seen = _lake(tb, "changes"), ENTITIES["enrollments"], []
    log, reader = jobs.change_log(lake, "enrollments"), Consumer(lake, "query")
    _landed(tb, lake, "enrollments", "first", NOW, where=STORED["enrollments"])
    reader.run({spec.table: log}, lambda spans: None)
    landing.land_envelopes(lake, "enrollments", resent_raw(tb, "enrollments"), "second")
    jobs.process_entity(lake, "enrollments", now=LATER)
    reader.run({spec.table: log}, lambda spans: seen.append(spans[spec.table]))
    return log.read(*seen[0]).select("change", *spec.fields)


@register("job_insert_activity")
def _(tb):
    """Activity that a second batch sends again is not stored again; filters tell which months have to be asked."""
    lake = _lake(tb, "activity")
    _landed(tb, lake, "activity_logs", "first", NOW, where=STORED["activity_logs"])
    _landed(tb, lake, "activity_logs", "second", LATER, where=RESENT["activity_logs"], changes=CHANGES["activity_logs"])
    return jobs.curated(lake, "activity_logs").select(*ENTITIES["activity_logs"].fields)


def _follow(tb: Testbed, facts: tuple[str, ...], refresh: Callable[[Rollups], int]) -> Lake:
    """Rollups of a stored part, brought up to date after two batches: changed enrollments in that part, and all rows that a feed sends
    again, as they are in the tables."""
    lake = _lake(tb, "incremental")
    for dim in ("students", "courses", "assignments"):
        lake.replace(f"curated/{ENTITIES[dim].table}", tb.curated(dim))
    for entity in facts:
        spec = ENTITIES[entity]
        lake.replace(f"curated/{spec.table}", stored_target(tb, entity).withColumn("part", jobs.month_of(spec.partition_time)), "part")
    refresh(Rollups(lake))
    again = f"({STORED['enrollments']}) AND ({RESENT['enrollments']})"
    _landed(tb, lake, "enrollments", "second", LATER, where=again, changes=CHANGES["enrollments"])
    for entity in facts:
        _landed(tb, lake, entity, "third", LATER, where=RESENT[entity])
    refresh(Rollups(lake))
    return lake


@register("job_incremental")
def _(tb):
    """Student and course performance that followed the changes."""
    lake = _follow(tb, ("enrollments", "submissions", "activity_logs"), lambda r: r.refresh_performance(now=LATER))
    return jobs.performance(lake).drop("calculated_at")


@register("job_incremental_courses")
def _(tb):
    """Course analytics that followed the changes, in which scores moved and moved back."""
    lake = _follow(tb, ("enrollments", "activity_logs"), lambda r: r.refresh_analytics(now=LATER))
    return _flat_grades(jobs.analytics(lake)).drop("calculated_at")


@register("job_constraints")
def _(tb):
    """Constraint counts that followed two batches: students that come after their enrollments, and re-sent enrollments."""
    lake = _lake(tb, "constraints")
    for dim in ("courses", "assignments"):
        lake.replace(f"curated/{ENTITIES[dim].table}", tb.curated(dim))
    lake.replace(f"curated/{ENTITIES['students'].table}", stored_target(tb, "students"))
    for entity in ("submissions", "activity_logs"):
        spec = ENTITIES[entity]
        lake.replace(f"curated/{spec.table}", tb.curated(entity).withColumn("part", jobs.month_of(spec.partition_time)), "part")
    spec = ENTITIES["enrollments"]
    lake.replace(f"curated/{spec.table}", stored_target(tb, "enrollments").withColumn("part", jobs.month_of(spec.partition_time)), "part")
    Constraints(lake).refresh()
    for entity in ("students", "enrollments"):
        _landed(tb, lake, entity, "second", LATER, where=RESENT[entity])
        Constraints(lake).refresh()
    return Constraints(lake).report()


@register("job_quality_checks")
def _(tb):
    lake = _lake(tb, "quality")
    for entity in ("students", "enrollments"):
        landing.land_envelopes(lake, entity, tb.raw(entity), "first")
        jobs.process_entity(lake, entity, now=NOW)
    jobs.check_quality(lake, now=NOW)
    # The run again, as after a failure: its counts and findings are there once.
    counts = jobs.check_quality(lake, now=NOW)
    found = lake.read("audit/dq_issues", DQ_ISSUES_SCHEMA).groupBy("check_name", "run").agg(F.count(F.lit(1)).alias("details"))
    return counts.join(found, ["check_name", "run"], "left").select(
        "check_name", "check_timestamp", "issues_found", F.coalesce("details", F.lit(0)).alias("details"))


@register("job_relanded_batch")
def _(tb):
    """A batch that was processed and lands again, changed: its new rows are loaded."""
    lake = _lake(tb, "relanded")
    landing.land_envelopes(lake, "students", tb.raw("students", where=STORED["students"]), "first")
    jobs.process_entity(lake, "students", now=NOW)
    landing.land_envelopes(lake, "students", resent_raw(tb, "students"), "first")
    jobs.process_entity(lake, "students", now=LATER)
    return jobs.curated(lake, "students").drop("student_key")


@register("job_transformations")
def _(tb):
    """Every named transformation over a loaded lake, and one that does not exist."""
    lake = _lake(tb, "transformations")
    for entity in ENTITIES:
        landing.land_envelopes(lake, entity, tb.raw(entity), "first")
        jobs.process_entity(lake, entity, now=NOW)
    names = [*jobs.TRANSFORMATIONS, "no_such_step"]
    done = [jobs.run_transformation(tb.spark, n, root=lake.root, now=LATER) for n in names]
    return reduce(DataFrame.unionByName, done).select("name", "status", "records_processed")


@register("job_triggered")
def _(tb):
    """For each customer segment a run is asked for; the log says so."""
    lake = _lake(tb, "triggered")
    jobs.log_triggers(lake, tb.students().select(F.col("major").alias("run_type")).distinct(), now=NOW)
    return lake.read("audit/run_events", RUN_EVENT_SCHEMA).select("run_type", "status", "event_at", "records_processed")


@register("job_reset_reload")
def _(tb):
    """A lake that holds data is emptied, then loaded from newly landed rows and refreshed."""
    lake = _lake(tb, "reload")
    for batch in ("first", "second"):
        jobs.reset(lake)
        for entity in ENTITIES:
            landing.land_envelopes(lake, entity, tb.raw(entity), batch)
        if batch == "first":
            jobs.process_entity(lake, "students", now=NOW)
    jobs.process_all(lake, now=LATER)
    jobs.refresh_aggregates(lake, now=LATER)
    return jobs.summary(lake)


@register("land_files")
def _(tb):
    """JSON and CSV files become enveloped rows; a torn line lands as it is."""
    lake, path = _lake(tb, "files"), scratch_dir(tb.spark, "files")
    torn = tb.raw("activity_logs").select(F.expr(TORN).alias("payload"))
    torn.write.text(f"{path}/json")
    tb.students().select("student_id", "major", "gpa").write.option("header", True).csv(f"{path}/csv")
    landing.land(lake, "activity_logs", landing.read_json_lines(tb.spark, f"{path}/json"), "json", now=NOW)
    landing.land(lake, "students", landing.read_csv(
        tb.spark, f"{path}/csv", "student_id string, major string, gpa decimal(3,2)"), "csv", now=NOW)
    for entity in ("students", "activity_logs"):
        jobs.process_entity(lake, entity, now=NOW)
    parts = [landing.raw_table(lake, e).select(F.lit(e).alias("entity"), "source_system", "processing_status")
             for e in ("students", "activity_logs")]
    return reduce(DataFrame.unionByName, parts).groupBy("entity", "source_system", "processing_status").count()


@register("job_cost_alerts")
def _(tb):
    lake, usage = _lake(tb, "alerts"), tb.metering("warehouse_metering")
    jobs.log_cost_alerts(lake, usage, now=ALERT_NOW)
    return jobs.log_cost_alerts(lake, usage, now=ALERT_NOW).select(_ALERT_COLS)


@register("job_daily_snapshot")
def _(tb):
    lake = _lake(tb, "snapshot")
    inputs = tb.metering("warehouse_metering"), tb.metering("container_history"), tb.rules()
    for day in (SNAPSHOT_DAY - timedelta(days=1), SNAPSHOT_DAY, SNAPSHOT_DAY):
        stored = jobs.capture_snapshot(lake, *inputs, day=day)
    return stored


@register("stream_upsert_students")
def _(tb):
    lake, landed = _lake(tb, "stream"), scratch_dir(tb.spark, "landing")
    lake.replace("curated/dim_students", stored_target(tb, "students"))
    resent_raw(tb, "students").write.json(landed)
    raw = streams.read_landing(tb.spark, landed)
    streams.stream_upsert(raw, "students", lake, checkpoint=f"{lake.root}/checkpoint", now=LATER).awaitTermination()
    return jobs.curated(lake, "students").drop("student_key")


@register("stream_rejected_rows")
def _(tb):
    """Rows of a stream that cannot be read, with the reason."""
    lake, landed = _lake(tb, "stream"), scratch_dir(tb.spark, "landing")
    tb.raw("activity_logs").withColumn("payload", F.expr(TORN)).write.json(landed)
    raw = streams.read_landing(tb.spark, landed)
    streams.stream_upsert(raw, "activity_logs", lake, checkpoint=f"{lake.root}/checkpoint", now=NOW).awaitTermination()
    return lake.read("audit/rejected", landing.REJECTED_SCHEMA).select("raw_id", "reason", "entity")


@register("stream_activity_dedup")
def _(tb):
    lake, landed = _lake(tb, "stream"), scratch_dir(tb.spark, "landing")
    tb.raw("activity_logs").write.json(landed)
    tb.raw("activity_logs", where=RESENT["activity_logs"], feed="again").write.mode("append").json(landed)
    rows = extract.extract(streams.read_landing(tb.spark, landed, files_per_batch=1), "activity_logs")
    spec = ENTITIES["activity_logs"]
    schema = ", ".join(f"{c} {t}" for c, t in spec.fields.items())
    streams.stream_insert_once(rows, lake, "activity", schema, key=spec.key,
                               checkpoint=f"{lake.root}/checkpoint").awaitTermination()
    return lake.read("activity", f"{schema}, batch bigint").drop("batch")


def _event_stream(tb: Testbed) -> DataFrame:
    """The events table, a file or a folder, as a stream."""
    schema = tb.table("events").schema
    return tb.spark.readStream.schema(schema).parquet(f"{tb.sf_dir.rstrip('/')}/[e]vents.parquet")


@register("stream_hourly_spike")
def _(tb):
    out = scratch_dir(tb.spark, "spikes")
    usage = _event_stream(tb).selectExpr(
        *[f"{e} AS {c}" for c, e in Testbed.metering_columns("warehouse_metering").items()]
    ).withColumn("start_time", F.col("start_time").cast("timestamp"))
    streams.stream_hourly_spike(usage, f"{out}/rows", checkpoint=f"{out}/checkpoint").awaitTermination()
    return tb.spark.read.parquet(f"{out}/rows")


def _spend(tb: Testbed) -> Lake:
    """Usage that arrives out of order: every third event first, the others in a second landing."""
    lake, landed = _lake(tb, "spend"), scratch_dir(tb.spark, "landing")
    columns = Testbed.metering_columns("warehouse_metering")
    usage = tb.table("events").select("event_id", *[F.expr(e).alias(c) for c, e in columns.items()])
    usage = usage.withColumn("start_time", F.col("start_time").cast("timestamp"))
    for first in (True, False):
        usage.where((F.col("event_id") % 3 == 0) == F.lit(first)).drop("event_id").write.mode("append").parquet(landed)
        stream = tb.spark.readStream.schema(usage.drop("event_id").schema).parquet(landed)
        streams.stream_spend(stream, lake, "spend", checkpoint=f"{lake.root}/checkpoint").awaitTermination()
    return lake


_SPEND_COLS = ("usage_hour", "warehouse_name", "CAST(estimated_cost_usd AS double) AS estimated_cost_usd", "spike", "state")


@register("stream_spend_open")
def _(tb):
    """Every hour so far, the last ones provisional."""
    return streams.spend_hours(_spend(tb), "spend").selectExpr(*_SPEND_COLS)


@register("stream_spend_closed")
def _(tb):
    """Every hour, closed at the end of the input."""
    lake = _spend(tb)
    streams.end_spend(lake, "spend")
    return streams.spend_hours(lake, "spend").selectExpr(*_SPEND_COLS)


def _refreshed(tb: Testbed, landings: int) -> DataFrame:
    """Answers of an index that the activity reached in ``landings`` landings, with some documents sent again in one more."""
    lake, landed = _lake(tb, "stream"), scratch_dir(tb.spark, "landing")
    source = search.activity_search_source(tb.activity())
    text = F.when(F.expr(AGAIN["changed"]), F.concat("search_text", F.lit(" again"))).otherwise(F.col("search_text"))
    again = source.where(AGAIN["sent"]).withColumn("search_text", F.when(~F.expr(AGAIN["emptied"]), text))
    # In its own micro-batch the newer of two copies counts.
    both = again.withColumn("version", F.lit(3)).unionByName(source.where(AGAIN["sent"]).withColumn("version", F.lit(2)))
    first = source.withColumn("version", F.lit(1))
    turn = F.pmod(F.xxhash64("activity_id"), landings)
    corpus = search.ACTIVITY_CORPUS
    # Each landing has as many files as Spark makes, and is one micro-batch of a run on the same checkpoint.
    for part in [*(first.where(turn == i) for i in range(landings)), both]:
        part.write.mode("append").parquet(landed)
        stream = tb.spark.readStream.schema(part.schema).parquet(landed)
        streams.stream_index(stream, corpus, lake, "activity", checkpoint=f"{lake.root}/checkpoint", order=["version"]).awaitTermination()
    return search.search(streams.stored_index(lake, "activity", corpus), _questions(source, "activity_type", "device_type"))


@register("stream_search_refresh")
def _(tb):
    """Documents that come again, changed or as they were, replace what the index had of them."""
    return _refreshed(tb, 1)


@register("search_many_refreshes")
def _(tb):
    """As stream_search_refresh after more micro-batches, some of whose segments are merged."""
    return _refreshed(tb, 5)
