"""Load, refresh and reset jobs over a table store."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import aggregates, cost, extract, generate, quality, runlog, upsert
from lectern.schemas import (
    ALERT_SCHEMA, COURSE_ANALYTICS_SCHEMA, DQ_ISSUES_SCHEMA, DQ_LOG_SCHEMA, ENTITIES, PERFORMANCE_SCHEMA, RAW_TABLES,
    RUN_EVENT_SCHEMA, SNAPSHOT_SCHEMA, Entity,
)
from lectern.sources import landing
from lectern.sources.changes import AFTER, BEFORE, DELETE, INSERT, ChangeLog
from lectern.sources.keyindex import KeyIndex, Membership
from lectern.sources.store import Lake

TOP_KEY_SCHEMA = "top bigint, writing boolean, table string"
PERFORMANCE, ANALYTICS = "agg_student_course_performance", "agg_course_analytics"


def table_schema(spec: Entity) -> str:
    return f"{spec.schema}, part string" if spec.partition_time else spec.schema


def curated(lake: Lake, entity: str) -> DataFrame:
    spec = ENTITIES[entity]
    df = lake.read(f"curated/{spec.table}", table_schema(spec))
    return df.drop("part") if spec.partition_time else df


def month_of(column: str):
    """Partition value of a fact. Its time column is never updated, so a row stays where it is."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))


def _by_month(df: DataFrame) -> DataFrame:
    """Few files per month: small months share a task, and a month too big for one task is split."""
    return df.hint("rebalance", "part")


def fact_index(lake: Lake, spec: Entity) -> KeyIndex:
    return KeyIndex(lake, f"curated/{spec.table}", spec.key)


def fact_filters(lake: Lake, spec: Entity) -> Membership:
    return Membership(lake, f"curated/{spec.table}", spec.key)


def change_log(lake: Lake, entity: str) -> ChangeLog:
    """What the merges changed of a curated table, commit by commit."""
    spec = ENTITIES[entity]
    return ChangeLog(lake, spec.table, table_schema(spec))


def merge_table(lake: Lake, spec: Entity, source: DataFrame, *, now: datetime, profile: str = "full") -> None:
    """Upsert ``source`` (one row per key, stored) into the curated table.

    The changes are stored first, then carried out, then published (see ``changes``). A dimension is rewritten to its next version. A fact
    rewrites only the months that hold matched or new rows, which its index knows, and an insert-only fact is appended to.
    """
    log = change_log(lake, spec.name)
    recover(lake, spec.name)
    name = f"curated/{spec.table}"
    if spec.partition_time is not None:
        source = source.withColumn("part", month_of(spec.partition_time))
    before = _stored_rows(lake, spec, source)
    empty = lake.empty(table_schema(spec))
    copies = 0
    if spec.updates:
        held = f"{lake.root}/staging/before/{spec.table}"
        before.write.mode("overwrite").parquet(held)
        before = lake.spark.read.schema(table_schema(spec)).parquet(held)
        # How often a key is stored at most. Without stored rows there is nothing to join with.
        copies = before.groupBy(spec.key).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        before = before if copies else empty
        # One join on the key, which also tells the rows that were there from the new ones.
        after = upsert.merge_entity(spec, before.withColumn("known", F.lit(AFTER)), source, now=now, profile=profile)
    else:
        after = upsert.insert_new(empty, source.join(before.select(spec.key), spec.key, "left_anti"), keys=[spec.key], now=now)
        after, before = after.withColumn("known", F.lit(None).cast("string")), empty
    top = _top_key(lake, spec)
    changed = upsert.number_rows(after, spec.surrogate, top)
    if copies > 1:
        # Each copy of a key that is stored more than once is written once for each of them.
        changed = changed.drop("known").join(before.select(spec.key, F.lit(AFTER).alias("known")), spec.key, "left")
    changed = changed.withColumn("change", F.coalesce("known", F.lit(INSERT))).drop("known")
    number = log.prepare(changed.unionByName(before.withColumn("change", F.lit(BEFORE))))
    lake.remove(f"{lake.root}/staging/before/{spec.table}")
    _carry_out(lake, spec, number)


def remove_rows(lake: Lake, entity: str, keys: DataFrame) -> int:
    """Take the rows with these keys out of the curated table and log them; returns their number."""
    spec = ENTITIES[entity]
    recover(lake, entity)
    log = change_log(lake, entity)
    gone = _stored_rows(lake, spec, keys.select(spec.key).distinct())
    number = log.prepare(gone.withColumn("change", F.lit(DELETE)))
    records = log.rows(number).count()
    _carry_out(lake, spec, number)
    return records


def recover(lake: Lake, entity: str) -> bool:
    """Carry out what a crash left stored but unpublished; says whether there was any."""
    number = change_log(lake, entity).pending()
    if number is not None:
        _carry_out(lake, ENTITIES[entity], number, again=True)
    return number is not None


def _stored_rows(lake: Lake, spec: Entity, keys: DataFrame) -> DataFrame:
    """The stored rows with one of ``keys``, from the months that may hold them."""
    name = f"curated/{spec.table}"
    if spec.partition_time is None:
        parts = None
    elif spec.updates:
        index = fact_index(lake, spec)
        index.ensure(lake.read(name, table_schema(spec)))
        parts = [r.part for r in index.months_of(keys).select("part").distinct().collect()]
    else:
        filters = fact_filters(lake, spec)
        filters.ensure(lake.read(name, table_schema(spec)))
        parts = filters.months(keys)
    if parts is not None:
        held = set(lake.partitions(name, "part"))
        parts = [p for p in parts if p in held]
    return lake.read(name, table_schema(spec), parts).join(keys.select(spec.key), spec.key, "left_semi")


def _carry_out(lake: Lake, spec: Entity, number: int, *, again: bool = False) -> None:
    """Bring the stored commit into indexes and table and publish it; doing so twice changes nothing."""
    log, name = change_log(lake, spec.name), f"curated/{spec.table}"
    rows = log.rows(number)
    new = rows.where(F.col("change").isin(INSERT, AFTER)).drop("change")
    # One row per month and kind of change.
    month = F.col("part") if spec.partition_time else F.lit(None)
    kinds = rows.groupBy(month.alias("part"), "change").agg(F.max(spec.surrogate).alias("top")).collect()
    top = max((r.top for r in kinds if r.top is not None and r.change == INSERT), default=None)
    if top is not None:
        _note_top(lake, spec, max(top, _top_key(lake, spec)))
    if spec.partition_time is None:
        rest = lake.read(name, table_schema(spec)).join(rows.select(spec.key), spec.key, "left_anti")
        lake.replace(name, rest.unionByName(new))
    else:
        index = fact_index(lake, spec) if spec.updates else fact_filters(lake, spec)
        index.ensure(lake.read(name, table_schema(spec)))
        inserted = rows.where(F.col("change") == INSERT).drop("change")
        if any(r.change == INSERT for r in kinds):
            index.add(inserted, f"commit-{number}")
        touched, removes = sorted({r.part for r in kinds}), any(r.change == DELETE for r in kinds)
        held = set(lake.partitions(name, "part"))
        there = lake.read(name, table_schema(spec), [p for p in touched if p in held])
        if spec.updates or removes:
            # New keys may be there only from an attempt that was cut off; a changed row is logged as it was, too.
            gone = rows.where(F.col("change").isin(BEFORE, DELETE, *([INSERT, AFTER] if again else [])))
            rest = there.join(gone.select(spec.key), spec.key, "left_anti").unionByName(new)
            left = {r.part for r in rest.select("part").distinct().collect()} if removes else set(touched)
            lake.replace_partitions(name, _by_month(rest), "part")
            for p in set(touched) - left:
                lake.drop_partition(name, f"part={p}")
        else:
            fresh = upsert.not_in(inserted, there, [spec.key]) if again else inserted
            lake.append(name, _by_month(fresh), "part")
        index.segments.note(version=(lake.versions(name) or [0])[-1])
    log.publish(number)


def _top_key(lake: Lake, spec: Entity) -> int:
    """The greatest surrogate key given so far: one stored number per entity. Where it is missing or marked, the table is asked."""
    state = lake.read("audit/top_keys", TOP_KEY_SCHEMA).where((F.col("table") == spec.table) & ~F.col("writing"))
    top = state.agg(F.max("top")).first()[0]
    if top is None:
        held = lake.read(f"curated/{spec.table}", table_schema(spec))
        top = held.agg(F.coalesce(F.max(spec.surrogate), F.lit(0))).first()[0]
    return top


def _note_top(lake: Lake, spec: Entity, top: int) -> None:
    lake.replace_partitions("audit/top_keys", lake.spark.createDataFrame([(top, False, spec.table)], TOP_KEY_SCHEMA), "table")


def staging_path(lake: Lake, entity: str, batch: str) -> str:
    return f"{lake.root}/staging/{entity}/{batch}"


def parse(lake: Lake, entity: str, rows: DataFrame, path: str) -> DataFrame:
    """Landed rows with their payload columns and, where they cannot be loaded, the reason; parsed once, stored and read back."""
    found = extract.parsed(rows, entity, keep=("batch", *upsert.BATCH_ORDER))
    found.write.mode("overwrite").parquet(path)
    return lake.spark.read.schema(found.schema).parquet(path)


def stage(lake: Lake, entity: str, parsed: DataFrame, path: str) -> DataFrame:
    """The readable rows, the last per key, with looked-up keys; stored, so that the optimizer knows their size."""
    spec = ENTITIES[entity]
    typed = parsed.where("reason IS NULL").select(*spec.fields, *upsert.BATCH_ORDER)
    last = upsert.latest_per_key(typed, [spec.key], keep_order=False)
    dims = {dim: curated(lake, dim) for dim, _ in spec.lookups.values()}
    found = upsert.lookup_keys(last, entity, dims)
    found.write.mode("overwrite").parquet(path)
    return lake.spark.read.schema(found.schema).parquet(path)


def load_rows(lake: Lake, entity: str, rows: DataFrame, run: str, *, now: datetime, profile: str = "full") -> DataFrame:
    """Merge landed rows (with their ``batch``) and note what cannot be read; returns row counts per batch.

    Rejected rows have one folder per entity and batch, so loading a batch again leaves them once.
    """
    folder = staging_path(lake, entity, run)
    parsed = parse(lake, entity, rows, f"{folder}/parsed")
    merge_table(lake, ENTITIES[entity], stage(lake, entity, parsed, f"{folder}/rows"), now=now, profile=profile)
    lake.remove(f"{folder}/rows")
    name = F.lit(entity).alias("entity")
    bad = parsed.where("reason IS NOT NULL").select("raw_id", "reason", name, "batch")
    lake.replace_partitions("audit/rejected", bad, "entity", "batch")
    return parsed.groupBy("batch").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("reason").isNotNull()).alias("rejected_count")
    ).select("row_count", "rejected_count", F.lit(now).cast("timestamp_ntz").alias("processed_at"), name, "batch")


def process_entity(lake: Lake, entity: str, *, now: datetime, profile: str = "full") -> int:
    """Load all pending batches of an entity; returns the number of landed rows."""
    batches = landing.pending_batches(lake, entity)
    if not batches:
        return 0
    run = uuid.uuid4().hex
    log = load_rows(lake, entity, landing.read_batches(lake, entity, batches), run, now=now, profile=profile)
    lake.replace_partitions("audit/batch_log", log, "entity", "batch")
    records = log.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
    lake.remove(staging_path(lake, entity, run))
    return records


def process_all(lake: Lake, *, now: datetime, profile: str = "full") -> int:
    """All entities, dimensions before the facts that look them up."""
    return sum(process_entity(lake, e, now=now, profile=profile) for e in ENTITIES)


def _update_rows(lake: Lake, entity: str, before: DataFrame, edit: Callable[[DataFrame], DataFrame]) -> int:
    """Change some stored rows and log it; returns their number."""
    recover(lake, entity)
    log = change_log(lake, entity)
    after = edit(before).select(*before.columns)
    number = log.prepare(before.withColumn("change", F.lit(BEFORE)).unionByName(after.withColumn("change", F.lit(AFTER))))
    records = log.rows(number).where(F.col("change") == AFTER).count()
    if records:
        _carry_out(lake, ENTITIES[entity], number)
    return records


def backfill_table(lake: Lake, entity: str) -> int:
    """Fill looked-up keys of rows that came before their dimension; only their months are rewritten."""
    spec = ENTITIES[entity]
    dims = {dim: curated(lake, dim) for dim, _ in spec.lookups.values()}
    facts = lake.read(f"curated/{spec.table}", table_schema(spec))
    can = F.lit(False)
    for fk, (dim, natural) in spec.lookups.items():
        facts = facts.join(dims[dim].select(natural, F.lit(True).alias(f"has_{fk}")), natural, "left")
        can = can | (F.col(fk).isNull() & F.col(f"has_{fk}"))
    return _update_rows(lake, entity, facts.where(can).select(*[c for c, _ in spec.columns], "part"),
                        lambda rows: upsert.backfill_keys(rows, entity, dims))


def transform_students(lake: Lake, *, now: datetime) -> int:
    stamp = F.lit(now).cast("timestamp_ntz")
    stale = (F.col("enrollment_status") == "Active") & (F.col("updated_at") < stamp - F.expr("INTERVAL '1' HOUR"))
    return _update_rows(lake, "students", curated(lake, "students").where(stale), lambda rows: upsert.touch_active_students(rows, now=now))


def transform_courses(lake: Lake, *, now: datetime) -> int:
    lapsed = ~F.coalesce(F.col("is_current"), F.lit(False))
    return _update_rows(lake, "courses", curated(lake, "courses").where(lapsed), lambda rows: upsert.refresh_current_courses(rows, now=now))


def transform_assignments(lake: Lake, *, now: datetime) -> int:
    process_entity(lake, "assignments", now=now)
    return 0


def refresh_performance(lake: Lake, *, now: datetime) -> int:
    names = ("students", "enrollments", "courses", "assignments", "submissions", "activity_logs")
    lake.replace(f"curated/{PERFORMANCE}",
                 aggregates.student_course_performance(*[curated(lake, n) for n in names], now=now))
    return lake.read(f"curated/{PERFORMANCE}", PERFORMANCE_SCHEMA).count()


def refresh_course_analytics(lake: Lake, *, now: datetime) -> int:
    lake.replace(f"curated/{ANALYTICS}", aggregates.course_analytics(
        curated(lake, "courses"), curated(lake, "enrollments"), curated(lake, "activity_logs"), now=now))
    return lake.read(f"curated/{ANALYTICS}", COURSE_ANALYTICS_SCHEMA).count()


def refresh_aggregates(lake: Lake, *, now: datetime) -> int:
    return refresh_performance(lake, now=now) + refresh_course_analytics(lake, now=now)


def count_students_at_risk(lake: Lake, *, now: datetime) -> int:
    return aggregates.student_risk(lake.read(f"curated/{PERFORMANCE}", PERFORMANCE_SCHEMA)).count()


def check_quality(lake: Lake, *, now: datetime) -> DataFrame:
    """Run the three checks, store their findings and counts under the run's id, and return the counts.

    A run is named by its time; running it again replaces what it found. ``run`` leads from a count to its findings.
    """
    run = now.strftime("%Y%m%dT%H%M%S%f")
    stamp, name = F.lit(now).cast("timestamp_ntz"), F.lit(run).alias("run")
    found = quality.dq_issues(curated(lake, "enrollments"), curated(lake, "students"))
    lake.drop_partition("audit/dq_issues", f"run={run}")
    lake.replace_partitions("audit/dq_issues", found.select("*", stamp.alias("check_timestamp"), name), "run")
    stored = lake.read("audit/dq_issues", DQ_ISSUES_SCHEMA).where(F.col("run") == run)
    lake.replace_partitions("audit/dq_log", quality.dq_report(stored, now=now).select("*", name), "run")
    return lake.read("audit/dq_log", DQ_LOG_SCHEMA).where(F.col("run") == run)


def log_cost_alerts(lake: Lake, metering: DataFrame, *, now: datetime) -> DataFrame:
    """Store the alerts that are new for their resource and period, and return all open ones."""
    logged = lake.read("audit/cost_alerts", ALERT_SCHEMA)
    lake.append("audit/cost_alerts", cost.new_alerts(cost.cost_alerts(metering, now=now), logged))
    return cost.open_alerts(lake.read("audit/cost_alerts", ALERT_SCHEMA))


def capture_snapshot(lake: Lake, metering: DataFrame, pools: DataFrame, rules: DataFrame, *, day: date) -> DataFrame:
    """Store one day's cost; a second run replaces that day. Returns all days."""
    snapshot = cost.daily_snapshot(metering, pools, rules, day=day)
    lake.replace_partitions("audit/daily_cost_snapshot", snapshot, "snapshot_date")
    return lake.read("audit/daily_cost_snapshot", SNAPSHOT_SCHEMA)


def log_trigger(lake: Lake, *, now: datetime, run_type: str = "CONTAINER_ETL") -> None:
    """Note that a run was asked for elsewhere."""
    event = runlog.run_event(lake.spark, uuid.uuid4().hex, run_type, "TRIGGERED", now=now)
    lake.append("audit/run_events", event)


def log_triggers(lake: Lake, types: DataFrame, *, now: datetime) -> None:
    """Note a run for each row of ``types`` (run_type), all in one write."""
    events = types.select(
        F.expr("uuid()").alias("run_id"), "run_type", F.lit("TRIGGERED").alias("status"), F.lit(now).cast("timestamp_ntz").alias("event_at"),
        F.lit(0).cast("bigint").alias("records_processed"), F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("string").alias("metadata"))
    lake.append("audit/run_events", events)


def performance(lake: Lake) -> DataFrame:
    """The stored student and course rollup."""
    return lake.read(f"curated/{PERFORMANCE}", PERFORMANCE_SCHEMA).select(*[c.split()[0] for c in PERFORMANCE_SCHEMA.split(", ")])


def analytics(lake: Lake) -> DataFrame:
    """The stored course rollup."""
    return lake.read(f"curated/{ANALYTICS}", COURSE_ANALYTICS_SCHEMA).drop("bucket")


def _nothing(lake: Lake, *, now: datetime) -> int:
    """Enrollments, submissions and activity are complete once loaded."""
    return 0


def transform_all(lake: Lake, *, now: datetime) -> int:
    steps = (transform_students, transform_courses, transform_assignments, refresh_aggregates, count_students_at_risk)
    return sum(step(lake, now=now) for step in steps)


TRANSFORMATIONS: dict[str, Callable[..., int]] = {
    "student_dimension": transform_students,
    "course_dimension": transform_courses,
    "assignment_dimension": transform_assignments,
    "enrollment_fact": _nothing,
    "submission_fact": _nothing,
    "activity_fact": _nothing,
    "student_performance_agg": refresh_performance,
    "course_analytics_agg": refresh_course_analytics,
}


def _load(entity: str, then: str):
    return lambda lake, *, now: process_entity(lake, entity, now=now) + TRANSFORMATIONS[then](lake, now=now)


def _full(lake: Lake, *, now: datetime) -> int:
    return process_all(lake, now=now) + transform_all(lake, now=now)


def _incremental(lake: Lake, *, now: datetime) -> int:
    """Load what landed since, and bring the rollups up to date from the changes alone."""
    from lectern.plans.rollups import Rollups

    records = process_all(lake, now=now)
    records += sum(step(lake, now=now) for step in (transform_students, transform_courses, transform_assignments))
    rollups = Rollups(lake)
    records += rollups.refresh_performance(now=now) + rollups.refresh_analytics(now=now)
    return records + count_students_at_risk(lake, now=now)


JOBS: dict[str, Callable[..., int]] = {
    "FULL_REFRESH": _full,
    "INCREMENTAL": _incremental,
    "STUDENTS": _load("students", "student_dimension"),
    "COURSES": _load("courses", "course_dimension"),
    "ENROLLMENTS": _load("enrollments", "enrollment_fact"),
    "SUBMISSIONS": _load("submissions", "submission_fact"),
    "ACTIVITY": _load("activity_logs", "activity_fact"),
}


def _run(spark: SparkSession, name: str, known: dict, root: str, now: datetime, texts: tuple[str, str]) -> DataFrame:
    result = "name string, status string, records_processed bigint, message string"
    unknown, finished = texts
    if name not in known:
        return spark.createDataFrame([(name, "UNKNOWN", 0, f"{unknown}: {name}")], result)
    lake, run_id = Lake(spark, root), uuid.uuid4().hex

    def log(status: str, **details) -> None:
        lake.append("audit/run_events", runlog.run_event(spark, run_id, name, status, now=now, **details))

    log("STARTED")
    try:
        records = known[name](lake, now=now)
        lake.drop_all_old_versions()
    except Exception as e:
        log("FAILED", error_message=str(e))
        return spark.createDataFrame([(name, "FAILED", 0, f"Error: {e}")], result)
    log("COMPLETED", records_processed=records)
    return spark.createDataFrame([(name, "COMPLETED", records, finished.format(name, records))], result)


def run_job(spark: SparkSession, job_type: str, *, root: str, now: datetime) -> DataFrame:
    """Run a named job and log it. An unknown name is answered, not raised."""
    return _run(spark, job_type, JOBS, root, now, ("Unknown job type", "ETL {} completed. Records processed: {}"))


def run_transformation(spark: SparkSession, name: str, *, root: str, now: datetime, **params) -> DataFrame:
    """Run a named transformation; ``params`` are accepted for later use."""
    return _run(spark, name, TRANSFORMATIONS, root, now,
                ("Unknown transformation", "Transformation {} completed. Records: {}"))


def run_status(lake: Lake) -> DataFrame:
    return runlog.job_status(runlog.latest_runs(lake.read("audit/run_events", RUN_EVENT_SCHEMA)))


def reset(lake: Lake) -> None:
    """Give every existing landing, curated and batch-log table an empty version; logs and indexes begin anew."""
    tables = {f"raw/{e}": (landing.BATCH_SCHEMA, ("batch",)) for e in RAW_TABLES}
    for spec in ENTITIES.values():
        tables[f"curated/{spec.table}"] = (table_schema(spec), ("part",) if spec.partition_time else ())
    tables[f"curated/{PERFORMANCE}"] = (PERFORMANCE_SCHEMA, ())
    tables[f"curated/{ANALYTICS}"] = (COURSE_ANALYTICS_SCHEMA, ())
    tables["audit/batch_log"] = (landing.BATCH_LOG_SCHEMA, ("entity", "batch"))
    tables["audit/rejected"] = (landing.REJECTED_SCHEMA, ("entity", "batch"))
    for name, (schema, parts) in tables.items():
        if lake.versions(name):
            lake.replace(name, lake.spark.createDataFrame([], schema), *parts)
    for area in ("changes", "index", "rollup"):
        lake.remove(f"{lake.root}/{area}")


def summary(lake: Lake) -> DataFrame:
    """One row with the size of every curated table."""
    tables = {n: curated(lake, n) for n in ENTITIES}
    tables["perf_aggregations"] = lake.read(f"curated/{PERFORMANCE}", PERFORMANCE_SCHEMA)
    return quality.data_summary(lake.spark, tables)


def reset_and_regenerate(lake: Lake, *, now: datetime, students: int = 200, courses: int = 30, per_student: int = 5,
                         per_course: int = 15, per_enrollment: int = 10, seed: int = 42) -> DataFrame:
    """Empty all tables, land a generated data set, load it, refresh the rollups and return the summary."""
    reset(lake)
    rows = generate.generate_all(lake.spark, students=students, courses=courses, per_student=per_student,
                                 per_course=per_course, per_enrollment=per_enrollment, seed=seed)
    for entity, df in rows.items():
        payloads = generate.as_payload(df, entity).withColumn("file_name", F.lit("synthetic_data_generator"))
        landing.land(lake, entity, payloads, f"seed-{seed}", now=now)
    process_all(lake, now=now)
    refresh_aggregates(lake, now=now)
    return summary(lake)
