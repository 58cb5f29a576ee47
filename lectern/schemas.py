"""Entities, curated tables and audit tables. Schemas are DDL strings."""

from __future__ import annotations

from dataclasses import dataclass, field

PENDING, PROCESSED, ERROR = "PENDING", "PROCESSED", "ERROR"

RAW_SCHEMA = (
    "raw_id string, payload string, source_system string, file_name string, "
    "ingested_at timestamp_ntz, processing_status string"
)


@dataclass(frozen=True)
class Entity:
    """One landed record type and the curated table it feeds.

    ``updates`` are the columns a matching record overwrites; ``narrow_updates`` is the smaller
    set of the scheduled SQL route. Every other column keeps its first value.
    """

    name: str
    table: str
    key: str
    surrogate: str
    fields: dict[str, str]
    updates: tuple[str, ...] = ()
    narrow_updates: tuple[str, ...] = ()
    lookups: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    tracks_updates: bool = True
    partition_time: str | None = None
    narrow_skips: tuple[str, ...] = ()

    def update_cols(self, profile: str = "full") -> tuple[str, ...]:
        if profile not in ("full", "sql"):
            raise ValueError(f"unknown upsert profile: {profile}")
        return self.narrow_updates if profile == "sql" and self.narrow_updates else self.updates

    @property
    def columns(self) -> list[tuple[str, str]]:
        cols = [(self.surrogate, "bigint"), (self.key, self.fields[self.key])]
        cols += [(fk, "bigint") for fk in self.lookups]
        cols += [(c, t) for c, t in self.fields.items() if c != self.key]
        cols.append(("created_at", "timestamp_ntz"))
        if self.tracks_updates:
            cols.append(("updated_at", "timestamp_ntz"))
        if "is_current" in self.defaults:
            cols.append(("is_current", "boolean"))
        return cols

    @property
    def schema(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in self.columns)


STUDENTS = Entity(
    "students", "dim_students", "student_id", "student_key",
    {
        "student_id": "string", "canvas_user_id": "bigint", "first_name": "string", "last_name": "string",
        "email": "string", "major": "string", "classification": "string", "enrollment_status": "string",
        "enrollment_date": "date", "expected_graduation": "date", "gpa": "decimal(3,2)", "advisor_id": "string",
    },
    updates=("canvas_user_id", "first_name", "last_name", "email", "major", "classification",
             "enrollment_status", "gpa", "advisor_id"),
    defaults={"is_current": "true"},
)
COURSES = Entity(
    "courses", "dim_courses", "course_id", "course_key",
    {
        "course_id": "string", "canvas_course_id": "bigint", "course_code": "string", "course_name": "string",
        "department": "string", "credit_hours": "int", "course_level": "string", "delivery_mode": "string",
        "term": "string", "academic_year": "string", "instructor_id": "string", "instructor_name": "string",
        "start_date": "date", "end_date": "date", "max_enrollment": "bigint",
    },
    updates=("canvas_course_id", "course_code", "course_name", "department", "credit_hours", "course_level",
             "delivery_mode", "term", "academic_year", "instructor_id", "instructor_name", "start_date",
             "end_date", "max_enrollment"),
    defaults={"is_current": "true"},
)
ASSIGNMENTS = Entity(
    "assignments", "dim_assignments", "assignment_id", "assignment_key",
    {
        "assignment_id": "string", "canvas_assignment_id": "bigint", "course_id": "string",
        "assignment_name": "string", "assignment_type": "string", "points_possible": "decimal(10,2)",
        "due_date": "timestamp_ntz", "unlock_date": "timestamp_ntz", "lock_date": "timestamp_ntz",
        "submission_types": "string", "is_group_assignment": "boolean", "weight": "decimal(5,2)",
    },
    updates=("assignment_name", "points_possible", "due_date", "weight"),
)
ENROLLMENTS = Entity(
    "enrollments", "fact_enrollments", "enrollment_id", "enrollment_key",
    {
        "enrollment_id": "string", "student_id": "string", "course_id": "string", "enrollment_state": "string",
        "enrollment_type": "string", "enrolled_at": "timestamp_ntz", "completed_at": "timestamp_ntz",
        "final_grade": "string", "final_score": "decimal(5,2)",
    },
    updates=("enrollment_state", "completed_at", "final_grade", "final_score"),
    narrow_updates=("enrollment_state", "final_grade", "final_score"),
    narrow_skips=("completed_at",),
    lookups={"student_key": ("students", "student_id"), "course_key": ("courses", "course_id")},
    partition_time="enrolled_at",
)
SUBMISSIONS = Entity(
    "submissions", "fact_submissions", "submission_id", "submission_key",
    {
        "submission_id": "string", "student_id": "string", "assignment_id": "string",
        "submitted_at": "timestamp_ntz", "graded_at": "timestamp_ntz", "score": "decimal(10,2)",
        "grade": "string", "points_possible": "decimal(10,2)", "percentage": "decimal(5,2)",
        "submission_type": "string", "attempt_number": "bigint", "late_flag": "boolean",
        "missing_flag": "boolean", "excused_flag": "boolean", "grader_id": "string",
    },
    updates=("graded_at", "score", "grade", "percentage", "late_flag", "missing_flag", "excused_flag", "grader_id"),
    narrow_updates=("graded_at", "score", "grade", "percentage"),
    lookups={"student_key": ("students", "student_id"), "assignment_key": ("assignments", "assignment_id")},
    partition_time="submitted_at",
)
ACTIVITY = Entity(
    "activity_logs", "fact_activity_logs", "activity_id", "activity_key",
    {
        "activity_id": "string", "student_id": "string", "course_id": "string", "activity_type": "string",
        "activity_timestamp": "timestamp_ntz", "duration_seconds": "bigint", "page_url": "string",
        "device_type": "string", "browser": "string", "ip_address": "string",
    },
    lookups={"student_key": ("students", "student_id"), "course_key": ("courses", "course_id")},
    tracks_updates=False,
    partition_time="activity_timestamp",
)

# Load order: a fact's dimensions always come first, so its looked-up keys are known on first load.
ENTITIES: dict[str, Entity] = {
    e.name: e for e in (STUDENTS, COURSES, ASSIGNMENTS, ENROLLMENTS, SUBMISSIONS, ACTIVITY)
}
# "grades" is landed but feeds no curated table.
RAW_TABLES = ("students", "courses", "enrollments", "assignments", "submissions", "grades", "activity_logs")

GRADE_BANDS: dict[str, tuple[str, ...]] = {
    "A": ("A", "A-"), "B": ("B+", "B", "B-"), "C": ("C+", "C", "C-"), "D": ("D+", "D", "D-"), "F": ("F",),
}

PERFORMANCE_SCHEMA = (
    "student_id string, course_id string, term string, total_assignments bigint, completed_assignments bigint, "
    "avg_score decimal(5,2), total_points_earned decimal(20,2), total_points_possible decimal(20,2), "
    "late_submissions bigint, missing_submissions bigint, total_activity_minutes bigint, last_activity_date date, "
    "current_grade string, calculated_at timestamp_ntz"
)
COURSE_ANALYTICS_SCHEMA = (
    "course_id string, term string, total_enrolled bigint, active_students bigint, avg_class_score decimal(5,2), "
    "median_class_score decimal(5,2), grade_distribution struct<A: bigint, B: bigint, C: bigint, D: bigint, F: bigint>, "
    "completion_rate decimal(5,2), avg_engagement_minutes bigint, at_risk_students bigint, calculated_at timestamp_ntz"
)
RUN_EVENT_SCHEMA = (
    "run_id string, run_type string, status string, event_at timestamp_ntz, records_processed bigint, "
    "error_message string, metadata string"
)
DQ_LOG_SCHEMA = "check_name string, check_timestamp timestamp_ntz, issues_found bigint, run string"
DQ_ISSUES_SCHEMA = "check_name string, record_id string, details string, check_timestamp timestamp_ntz, run string"
RULES_SCHEMA = (
    "resource_type string, resource_name string, cost_center string, department string, project string"
)
SNAPSHOT_SCHEMA = (
    "snapshot_date date, resource_type string, resource_name string, credits_used decimal(20,10), "
    "estimated_cost_usd decimal(15,2), cost_center string, department string, project string"
)
ALERT_SCHEMA = (
    "alert_type string, resource_type string, resource_name string, period timestamp_ntz, "
    "threshold_value decimal(15,2), current_value decimal(15,2), alert_message string, "
    "alert_timestamp timestamp_ntz, acknowledged boolean, acknowledged_by string, acknowledged_at timestamp_ntz"
)
