"""The star schema and the metering tables, derived from the benchmark's order tables.

A customer is a student, a part is a course, an order line enrolls its customer in its part, and
every pair of consecutive events is activity on one order's first course. All rows of the tables
take part, and every derived frame grows with them. The column expressions are valid in Spark SQL
and in DuckDB alike, so the oracle builds the same inputs from them.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.schemas import ENTITIES, PENDING, RULES_SCHEMA

NOW = datetime(2024, 2, 1, 6, 0, 0)
AS_OF = date(2024, 1, 31)
ORDERS_AS_OF = date(2001, 8, 1)


def padded(number: str, digits: int) -> str:
    """A number as text of at least that many digits."""
    text = f"CAST({number} AS STRING)"
    return f"lpad({text}, CAST(greatest(length({text}), {digits}) AS INT), '0')"


STUDENT = {
    "student_key": "c_custkey + 1",
    "student_id": f"concat('U', {padded('c_custkey', 12)})",
    "canvas_user_id": "100000 + c_custkey",
    "first_name": "concat('F', CAST(c_custkey % 97 AS STRING))",
    "last_name": "concat('L', CAST(c_custkey % 89 AS STRING))",
    "email": f"concat('u', {padded('c_custkey', 12)}, '@demo-university.edu')",
    "major": "c_mktsegment",
    "classification": "CASE c_custkey % 4 WHEN 0 THEN 'Freshman' WHEN 1 THEN 'Sophomore' WHEN 2 THEN 'Junior' ELSE 'Senior' END",
    "enrollment_status": "CASE WHEN c_custkey % 6 = 4 THEN 'Inactive' WHEN c_custkey % 6 = 5 THEN 'Probation' ELSE 'Active' END",
    "enrollment_date": "make_date(CAST(2024 - c_custkey % 4 AS INT), 8, CAST(15 + c_custkey % 11 AS INT))",
    "expected_graduation": "make_date(CAST(2028 - c_custkey % 4 AS INT), 5, 15)",
    "gpa": "CAST(CAST(floor(c_acctbal / 25) AS INT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2))",
    "advisor_id": "concat('ADV', CAST(1000 + c_custkey % 50 AS STRING))",
    "is_current": "true",
}
COURSE = {
    "course_key": "p_partkey + 1",
    "course_id": f"concat('CRS', {padded('p_partkey', 12)})",
    "canvas_course_id": "10000 + p_partkey",
    "course_code": "concat(substr(p_type, 1, 3), '-', CAST(1000 + p_partkey AS STRING))",
    "course_name": "p_name",
    "department": "p_type",
    "credit_hours": "CAST(p_size % 4 + 1 AS INT)",
    "course_level": "CASE WHEN p_size > 40 THEN 'Graduate' ELSE 'Undergraduate' END",
    "delivery_mode": "CASE p_partkey % 3 WHEN 0 THEN 'In-Person' WHEN 1 THEN 'Online' ELSE 'Hybrid' END",
    "term": "CASE WHEN p_partkey % 2 = 0 THEN 'Fall 2024' ELSE 'Spring 2025' END",
    "academic_year": "'2024-2025'",
    "instructor_id": "concat('INS', CAST(1000 + p_partkey % 250 AS STRING))",
    "instructor_name": "concat('Instructor ', CAST(p_partkey % 250 AS STRING))",
    "start_date": "CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-08-19' ELSE DATE '2025-01-08' END",
    "end_date": "CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-12-13' ELSE DATE '2025-05-01' END",
    "max_enrollment": "CAST(p_size * 5 AS BIGINT)",
    "is_current": "p_partkey % 7 <> 0",
}
# Up to five assignments per course; p_size decides how many, so some courses have none.
ASSIGNMENTS_PER_COURSE = "p_size % 6"
ASSIGNMENT_BASE = {
    "assignment_key": "p_partkey * 5 + i + 1",
    "course_id": COURSE["course_id"],
    "idx": "i",
    "assignment_type": "CASE (p_partkey + i) % 6 WHEN 0 THEN 'Quiz' WHEN 1 THEN 'Homework' WHEN 2 THEN 'Exam' WHEN 3 THEN 'Project' WHEN 4 THEN 'Discussion' ELSE 'Lab' END",
    "points_possible": "CAST(10 * (i + 1) AS DECIMAL(10,2))",
    "due_day": "make_date(2024, CAST(9 + i % 3 AS INT), CAST(1 + (p_partkey + i) % 28 AS INT))",
    "p_size": "p_size",
}
ASSIGNMENT = {
    "assignment_key": "assignment_key",
    "assignment_id": f"concat('ASN', {padded('assignment_key', 13)})",
    "canvas_assignment_id": "99999 + assignment_key",
    "course_id": "course_id",
    "idx": "idx",
    "assignment_name": "concat(assignment_type, ' ', CAST(idx + 1 AS STRING))",
    "assignment_type": "assignment_type",
    "points_possible": "points_possible",
    "due_date": "CAST(due_day AS TIMESTAMP) + INTERVAL '86340' SECOND",
    "unlock_date": "CAST(due_day - INTERVAL '7' DAY AS TIMESTAMP)",
    "lock_date": "CAST(due_day + INTERVAL '3' DAY AS TIMESTAMP) + INTERVAL '86340' SECOND",
    "submission_types": "CASE WHEN assignment_type = 'Quiz' THEN 'online_quiz' ELSE 'online_upload,online_text_entry' END",
    "is_group_assignment": "assignment_type = 'Project' AND assignment_key % 2 = 0",
    "weight": "CAST(5 + assignment_key % 20 AS DECIMAL(5,2))",
    "p_size": "p_size",
}
ENROLLMENT_BASE = {
    "rf": "min(l_returnflag)",
    "od": "min(o_orderdate)",
    "ln": "max(l_linenumber)",
    "q": "max(l_quantity)",
    "sd": "max(l_shipdate)",
}
ENROLLMENT = {
    "s": "o_custkey",
    "enrollment_id": f"concat('ENR', {padded('o_custkey', 12)}, '-', {padded('l_partkey', 12)})",
    "student_id": f"concat(CASE WHEN o_custkey % 100 = 99 THEN 'X' ELSE 'U' END, {padded('o_custkey', 12)})",
    "course_id": f"concat('CRS', {padded('l_partkey', 12)})",
    "ln": "ln",
    "enrollment_state": "CASE rf WHEN 'A' THEN 'active' WHEN 'N' THEN 'completed' ELSE 'dropped' END",
    "enrollment_type": "'StudentEnrollment'",
    "enrolled_at": "od",
    "completed_at": "CASE WHEN rf = 'N' THEN sd END",
    "final_score": "CASE WHEN ln = 7 THEN NULL ELSE CAST(50 + q AS DECIMAL(5,2)) END",
    "final_grade": "CASE WHEN ln = 7 THEN NULL WHEN q >= 48 THEN 'A' WHEN q >= 44 THEN 'A-' WHEN q >= 39 THEN 'B+' WHEN q >= 34 THEN 'B' WHEN q >= 30 THEN 'B-' WHEN q >= 26 THEN 'C+' WHEN q >= 20 THEN 'C' WHEN q >= 15 THEN 'C-' WHEN q >= 10 THEN 'D' ELSE 'F' END",
}
# A student hands in the first assignments of a course, as many as the highest line number.
SUBMISSION_MATCH = "idx < ln"
_MARK = "(s * 31 + assignment_key * 17) % 101"
SUBMISSION = {
    "submission_id": f"concat('SUB', {padded('s', 12)}, '-', {padded('assignment_key', 13)})",
    "student_id": "student_id",
    "assignment_id": "assignment_id",
    "enrolled_at": "enrolled_at",
    "submitted_at": "due_date + INTERVAL '1' HOUR * CAST((s + assignment_key) % 50 - 48 AS INT)",
    "graded_at": "due_date + INTERVAL '1' HOUR * CAST((s + assignment_key) % 50 - 48 AS INT) + INTERVAL '1' DAY * CAST(1 + (s + assignment_key) % 7 AS INT)",
    "score": f"CAST(points_possible * ({_MARK}) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))",
    "grade": f"CASE WHEN {_MARK} >= 90 THEN 'A' WHEN {_MARK} >= 80 THEN 'B' WHEN {_MARK} >= 70 THEN 'C' WHEN {_MARK} >= 60 THEN 'D' ELSE 'F' END",
    "points_possible": "points_possible",
    "percentage": f"CAST({_MARK} AS DECIMAL(5,2))",
    "submission_type": "CASE WHEN (s + assignment_key) % 2 = 0 THEN 'online_upload' ELSE 'online_text_entry' END",
    "attempt_number": "1 + (s + assignment_key) % 3",
    "late_flag": "(s + assignment_key) % 10 = 1",
    "missing_flag": "(s + assignment_key) % 25 = 1",
    "excused_flag": "(s + assignment_key) % 50 = 3",
    "grader_id": "concat('GRD', CAST(1000 + assignment_key % 30 AS STRING))",
}
EVENT_ORDER = "CAST(floor(event_id / 2) AS BIGINT)"
ACTIVITY = {
    "activity_id": f"concat('ACT', {padded('event_id', 14)})",
    "student_id": f"'U' || {padded('o_custkey', 12)}",
    "course_id": f"'CRS' || {padded('first_part', 12)}",
    "activity_type": "CASE event_type WHEN 'click' THEN 'Assignment' WHEN 'error' THEN 'Quiz' WHEN 'purchase' THEN 'FileDownload' WHEN 'signup' THEN 'Discussion' ELSE 'PageView' END",
    "activity_timestamp": "ts",
    "duration_seconds": "CAST(floor(value) AS BIGINT) + 10",
    "page_url": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE '/courses/' || CAST(first_part AS STRING) || '/' || lower(event_type) || '/' || CAST(event_id % 100 AS STRING) END",
    "device_type": "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Desktop' WHEN event_id % 3 = 1 THEN 'Mobile' ELSE 'Tablet' END",
    "browser": "CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 'Chrome' WHEN event_id % 4 = 1 THEN 'Safari' WHEN event_id % 4 = 2 THEN 'Firefox' ELSE 'Edge' END",
    "ip_address": "concat('10.0.', CAST(event_id % 256 AS STRING), '.', CAST(1 + event_id % 254 AS STRING))",
}
_EVENT_END = "ts + INTERVAL '1' SECOND * CAST(event_id % 600 AS INT)"
_CREDITS = "CAST(value AS DECIMAL(12,2))"
_DATABASE = "CASE WHEN event_id % 11 = 0 THEN 'OTHER_DB' ELSE 'DEMO_CANVAS_DB' END"
_POOL_SPLIT = {
    "credits_used": _CREDITS,
    "credits_used_compute": f"CAST({_CREDITS} * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(14,3))",
    "credits_used_cloud_services": f"CAST({_CREDITS} * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(14,3))",
}
# frame: (source table, row filter, columns, group by)
METERING: dict[str, tuple[str, str, dict[str, str], str]] = {
    "warehouse_metering": ("events", "", {
        "start_time": "ts",
        "end_time": _EVENT_END,
        "warehouse_name": "CASE WHEN event_type = 'error' THEN 'OTHER_ERROR_WH' ELSE concat('DEMO_', upper(event_type), '_WH') END",
        "credits_used": _CREDITS,
    }, ""),
    "warehouse_metering_long": ("orders", "", {
        "start_time": "o_orderdate",
        "end_time": "o_orderdate + INTERVAL '1' HOUR",
        "warehouse_name": "concat('DEMO_', substr(o_orderpriority, 1, 1), '_WH')",
        "credits_used": "CAST(o_totalprice AS DECIMAL(18,2))",
    }, ""),
    "container_history": ("events", "", {
        "start_time": "ts",
        "compute_pool_name": "concat('DEMO_POOL_', CAST(event_id % 3 AS STRING))",
        **_POOL_SPLIT,
        "active_node_count": "CAST(1 + event_id % 2 AS INT)",
    }, ""),
    "task_history": ("events", "", {
        "scheduled_time": "ts",
        "query_start_time": "ts",
        "completed_time": _EVENT_END,
        "database_name": _DATABASE,
        "schema_name": "'RAW'",
        "name": "concat('TASK_', upper(event_type))",
        "state": "CASE WHEN event_id % 20 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END",
        "error_code": "CASE WHEN event_id % 20 = 0 THEN 'E100' END",
        "error_message": "CASE WHEN event_id % 20 = 0 THEN concat('failure ', CAST(event_id AS STRING)) END",
        "credits_used": _CREDITS,
    }, ""),
    "database_storage": ("events", "", {
        "usage_date": "CAST(ts AS DATE)",
        "database_name": "'DEMO_CANVAS_DB'",
        "average_database_bytes": "CAST(count(*) * 104857601 AS BIGINT)",
        "average_failsafe_bytes": "CAST(count(*) * 1234567 + max(user_id) AS BIGINT)",
    }, "CAST(ts AS DATE)"),
    "table_storage": ("part", "", {
        "table_catalog": "CASE WHEN p_size = 50 THEN 'OTHER_DB' ELSE 'DEMO_CANVAS_DB' END",
        "table_schema": "p_type",
        "table_name": "concat('T', CAST(p_partkey AS STRING))",
        "active_bytes": "p_partkey * 1048583",
        "time_travel_bytes": "p_partkey * 1031",
        "failsafe_bytes": "p_partkey * 517",
        "row_count": "CAST(p_size % 10 AS BIGINT)",
        "deleted": "CASE WHEN p_partkey % 9 = 0 THEN DATE '2024-01-01' END",
    }, ""),
    "serverless_history": ("events", "", {
        "start_time": "ts",
        "end_time": _EVENT_END,
        "database_name": _DATABASE,
        **_POOL_SPLIT,
    }, ""),
    "service_logs": ("events", "", {
        "timestamp": "ts",
        "record": "concat('{\"severity\":\"', CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END, '\"}')",
        "value": "concat(event_type, ' ', props)",
    }, ""),
}
RULES = [
    ("WAREHOUSE", "DEMO_CLICK_WH", "DATA_PLATFORM", "IT", "LMS"),
    ("WAREHOUSE", "DEMO_VIEW_WH", "DATA_PLATFORM", "IT", "LMS"),
    ("COMPUTE_POOL", "DEMO_POOL_0", "DATA_PLATFORM", "IT", "LMS"),
    ("CONTAINER", "DEMO_SIGNUP_WH", "RESEARCH", "LAB", "PILOT"),
]
# Each order is one job run: it starts on the order date, and the order status tells how it ended.
RUN = {
    "run_id": f"concat('RUN', {padded('o_orderkey', 12)})",
    "run_type": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'DEPLOYMENT' WHEN '2' THEN 'FULL_REFRESH' WHEN '3' THEN 'INCREMENTAL' WHEN '4' THEN 'STUDENTS' ELSE 'CONTAINER_ETL' END",
    "started_at": "o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey % 1440 AS INT)",
    "final_status": "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' END",
    "records_processed": "CAST(floor(o_totalprice) AS BIGINT)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])


def _curated(df: DataFrame, entity: str, *extra: str) -> DataFrame:
    """The curated column types; keys and stamps that the mapping lacks are added."""
    spec = ENTITIES[entity]
    have = set(df.columns)
    stamps = ("created_at", "updated_at")
    return df.selectExpr(*[
        f"CAST({f"TIMESTAMP '{NOW}'" if c in stamps else c} AS {t}) AS {c}"
        for c, t in spec.columns if c in have or c in stamps
    ], *extra)


class Testbed:
    """Curated frames, raw landings and metering frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        # Opening a table reads a file footer, so each one is opened once.
        self.table = cache(lambda name: table(spark, sf_dir, name))
        self._assignments = cache(self._derive_assignments)
        self._enrollments = cache(self._derive_enrollments)

    def students(self, *extra: str) -> DataFrame:
        return _curated(self.table("customer").selectExpr("*", *[f"{e} AS {c}" for c, e in STUDENT.items()]),
                        "students", *extra)

    def courses(self, *extra: str) -> DataFrame:
        return _curated(self.table("part").selectExpr("*", *[f"{e} AS {c}" for c, e in COURSE.items()]),
                        "courses", *extra)

    def _derive_assignments(self) -> DataFrame:
        wanted = F.expr(ASSIGNMENTS_PER_COURSE).cast("int")
        slots = F.when(wanted > 0, F.sequence(F.lit(0), wanted - 1)).otherwise(F.array().cast("array<int>"))
        base = self.table("part").withColumn("i", F.explode(slots))
        return _select(_select(base, ASSIGNMENT_BASE), ASSIGNMENT)

    def assignments(self, *extra: str) -> DataFrame:
        return _curated(self._assignments(), "assignments", *extra)

    def _derive_enrollments(self) -> DataFrame:
        lines = self.table("lineitem").join(self.table("orders"), F.expr("l_orderkey = o_orderkey"))
        grouped = lines.groupBy("o_custkey", "l_partkey").agg(
            *[F.expr(e).alias(c) for c, e in ENROLLMENT_BASE.items()]
        )
        return _select(grouped, ENROLLMENT)

    def enrollments(self, *extra: str) -> DataFrame:
        return _curated(self._enrollments(), "enrollments", *extra)

    def submissions(self, *extra: str) -> DataFrame:
        pairs = self._enrollments().join(self._assignments(), "course_id").where(SUBMISSION_MATCH)
        return _curated(_select(pairs, SUBMISSION), "submissions", *extra)

    def activity(self, *extra: str) -> DataFrame:
        first = self.table("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("first_part"))
        events = self.table("events").join(
            self.table("orders").select("o_orderkey", "o_custkey"), F.expr(f"{EVENT_ORDER} = o_orderkey"), "left"
        ).join(first, F.expr("o_orderkey = l_orderkey"), "left")
        return _curated(_select(events, ACTIVITY), "activity_logs", *extra)

    def curated(self, entity: str, *extra: str) -> DataFrame:
        return getattr(self, "activity" if entity == "activity_logs" else entity)(*extra)

    def raw(self, entity: str, *, changes: dict[str, str] | None = None, status: str = f"'{PENDING}'",
            feed: str = "feed", ingested_at: datetime = NOW, where: str | None = None,
            helpers: tuple[str, ...] = (), stale: tuple[str, datetime] | None = None) -> DataFrame:
        """The landing envelope of one entity: every payload column of every row as a JSON string.

        ``changes`` replaces payload columns, ``where`` picks the part of the table a feed re-sends,
        and ``stale`` names an earlier feed that sent the same rows unchanged.
        """
        spec = ENTITIES[entity]
        df = self.curated(entity, *helpers)
        if where:
            df = df.where(where)

        def copy(name: str, at: datetime, edits: dict[str, str]):
            values = {c: F.expr(edits[c]).cast(t) if c in edits else F.col(c) for c, t in spec.fields.items()}
            payload = F.to_json(F.struct(*[
                (F.date_format(values[c], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if t == "timestamp_ntz" else values[c]).alias(c)
                for c, t in spec.fields.items()
            ]))
            return F.struct(
                F.concat(F.lit(f"{name}-"), F.col(spec.key)).alias("raw_id"), payload.alias("payload"),
                F.lit(f"{name}.json").alias("file_name"), F.lit(at).cast("timestamp_ntz").alias("ingested_at"),
            )

        copies = [copy(feed, ingested_at, changes or {})] + ([copy(*stale, {})] if stale else [])
        sent = F.explode(F.array(*copies)) if stale else copies[0]
        return df.select(sent.alias("r"), F.expr(status).alias("processing_status")).select(
            "r.raw_id", "r.payload", F.lit("CANVAS_LMS").alias("source_system"), "r.file_name", "r.ingested_at",
            "processing_status",
        )

    def metering(self, name: str) -> DataFrame:
        source, where, cols, group = METERING[name]
        df = self.table(source)
        if where:
            df = df.where(where)
        if group:
            keys = {c: e for c, e in cols.items() if e == group}
            aggs = [F.expr(e).alias(c) for c, e in cols.items() if e != group]
            df = df.groupBy(*[F.expr(e).alias(c) for c, e in keys.items()]).agg(*aggs)
            return df.select(*cols)
        return _select(df, cols)

    @staticmethod
    def metering_columns(name: str) -> dict[str, str]:
        return METERING[name][2]

    def rules(self) -> DataFrame:
        return self.spark.createDataFrame(RULES, RULES_SCHEMA)

    def run_events(self) -> DataFrame:
        """Two rows per finished run, one per run still open."""
        runs = _select(self.table("orders"), RUN)
        cols = ["run_id", "run_type", "status", "event_at", "records_processed", "error_message", "metadata"]
        event = F.explode(F.filter(F.array(
            F.struct(F.lit("STARTED").alias("status"), F.col("started_at").alias("event_at"),
                     F.lit(0).cast("bigint").alias("records"), F.lit(None).cast("string").alias("error_message")),
            F.struct(F.col("final_status").alias("status"),
                     F.expr("started_at + INTERVAL '1' HOUR").alias("event_at"),
                     F.col("records_processed").alias("records"),
                     F.expr("CASE WHEN final_status = 'FAILED' THEN concat('run ', run_id, ' failed') END").alias("error_message")),
        ), lambda e: e["status"].isNotNull()))
        return runs.select("run_id", "run_type", event.alias("e")).select(
            "run_id", "run_type", "e.status", "e.event_at", F.col("e.records").alias("records_processed"),
            "e.error_message", F.lit(None).cast("string").alias("metadata"),
        ).select(*cols)
