"""Metric layer: named dimensions, facts and metrics over one base view."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# An average that is rounded nowhere: the exact decimal or integer sum over the count.
MEAN = "try_divide(CAST(sum({0}) AS DOUBLE), count({0}))"


@dataclass(frozen=True)
class Model:
    """Each mapping goes from a public name to a Spark SQL expression over the base view."""

    name: str
    dimensions: Mapping[str, str]
    metrics: Mapping[str, str]
    facts: Mapping[str, str] = field(default_factory=dict)

    def with_metric(self, name: str, expr: str) -> "Model":
        return replace(self, metrics={**self.metrics, name: expr})

    def with_dimension(self, name: str, expr: str) -> "Model":
        return replace(self, dimensions={**self.dimensions, name: expr})


def _pick(names: Iterable[str], known: Mapping[str, str], kind: str, model: Model) -> list[Column]:
    picked = []
    for n in names:
        if n not in known:
            raise KeyError(f"{model.name} has no {kind} named {n}")
        picked.append(F.expr(known[n]).alias(n))
    return picked


def metric_query(base: DataFrame, model: Model, metrics: Iterable[str], dimensions: Iterable[str] = (),
                 where: str | Column | None = None) -> DataFrame:
    """``metrics`` grouped by ``dimensions``; ``where`` filters on base columns."""
    dims = _pick(dimensions, model.dimensions, "dimension", model)
    aggs = _pick(metrics, model.metrics, "metric", model)
    if where is not None:
        base = base.where(where)
    return base.groupBy(*dims).agg(*aggs)


def fact_query(base: DataFrame, model: Model, facts: Iterable[str], dimensions: Iterable[str] = (),
               where: str | Column | None = None) -> DataFrame:
    """Row-level facts next to their dimensions, without aggregation."""
    cols = _pick(dimensions, model.dimensions, "dimension", model) + _pick(facts, model.facts, "fact", model)
    if where is not None:
        base = base.where(where)
    return base.select(*cols)


def _same(*names: str, **renamed: str) -> dict[str, str]:
    return {**{n: n for n in names}, **renamed}


STUDENT_MODEL = Model(
    "student_analytics",
    dimensions=_same(
        "student_id", "first_name", "last_name", "email", "major", "classification", "enrollment_status",
        "enrollment_date", "academic_standing", student_name="full_name", graduation_date="expected_graduation",
    ),
    facts={"student_gpa": "gpa"},
    metrics={
        "total_students": "count(student_id)",
        "average_gpa": MEAN.format("gpa"),
        "active_students": "count_if(enrollment_status = 'Active')",
        "at_risk_students": "count_if(gpa < 2.0)",
        "deans_list_students": "count_if(gpa >= 3.5)",
    },
)
COURSE_MODEL = Model(
    "course_analytics",
    dimensions=_same(
        "course_id", "course_code", "course_name", "department", "term", "delivery_mode", "start_date", "end_date",
        "course_level", instructor="instructor_name",
    ),
    facts={"course_credits": "credit_hours", "max_seats": "max_enrollment"},
    metrics={
        "total_courses": "count(course_id)",
        "total_credit_hours": "sum(credit_hours)",
        "total_capacity": "sum(max_enrollment)",
        "current_courses": "count_if(is_current)",
        "unique_instructors": "count(DISTINCT instructor_name)",
    },
)
ENROLLMENT_MODEL = Model(
    "enrollment_analytics",
    dimensions=_same(
        "enrollment_id", "student_id", "student_name", "student_major", "student_classification", "course_id",
        "course_code", "course_name", "department", "term", "enrollment_status", "enrollment_date",
        "grade_category", instructor="instructor_name", letter_grade="final_grade",
    ),
    facts={"grade_point": "grade_points", "credit_hours": "credit_hours"},
    metrics={
        "total_enrollments": "count(enrollment_id)",
        "unique_students": "count(DISTINCT student_id)",
        "unique_courses": "count(DISTINCT course_id)",
        "average_grade_points": MEAN.format("grade_points"),
        "total_credit_hours": "sum(credit_hours)",
    },
)
SUBMISSION_MODEL = Model(
    "submission_analytics",
    dimensions=_same(
        "submission_id", "assignment_id", "assignment_name", "assignment_type", "student_id", "student_name",
        "student_major", "submission_date", "due_date", "grade", "score_category", is_late="late_flag",
    ),
    facts={"submission_score": "score", "max_points": "points_possible", "attempts": "attempt_number"},
    metrics={
        "total_submissions": "count(submission_id)",
        "unique_students_submitted": "count(DISTINCT student_id)",
        "average_score": MEAN.format("score"),
        "late_submission_count": "count_if(late_flag)",
    },
)
PERFORMANCE_MODEL = Model(
    "performance_dashboard",
    dimensions=_same(
        "student_id", "student_name", "major", "classification", "overall_gpa", "course_id", "course_code",
        "course_name", "department", "term", "completion_rate", instructor="instructor_name",
        course_grade="performance_grade",
    ),
    facts={
        "assignments_total": "total_assignments", "assignments_completed": "completed_assignments",
        "avg_assignment_score": "average_score", "points_earned": "total_points_earned",
        "points_possible": "total_points_possible", "late_count": "late_submissions",
        "missing_count": "missing_submissions",
    },
    metrics={
        "total_records": "count(1)",
        "avg_course_score": MEAN.format("average_score"),
        "total_late_submissions": "sum(late_submissions)",
        "students_at_risk": "count_if(average_score < 60)",
        "high_performers": "count_if(average_score >= 90)",
    },
)
MODELS = {m.name: m for m in (STUDENT_MODEL, COURSE_MODEL, ENROLLMENT_MODEL, SUBMISSION_MODEL, PERFORMANCE_MODEL)}
