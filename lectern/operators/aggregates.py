"""Student and course rollups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.scalars import count_where, half_up_minutes, mean, ratio
from lectern.schemas import GRADE_BANDS

PAIR = ["student_id", "course_id"]


def engagement_minutes(activity: DataFrame) -> DataFrame:
    """Whole minutes of activity per student and course."""
    return activity.groupBy(*PAIR).agg(
        half_up_minutes(F.sum("duration_seconds")).alias("total_minutes"),
    )


def _submission_totals(submissions: DataFrame, assignments: DataFrame, compat: bool) -> DataFrame:
    """Submissions reduced to one row per student and course."""
    marks = submissions.select(
        "student_id", "assignment_id", "submission_id", "percentage", "score", "points_possible",
        "late_flag", "missing_flag",
    ).join(assignments.select("assignment_id", "course_id"), "assignment_id")
    sums = {
        "completed": F.count("submission_id"),
        "pct_sum": F.sum("percentage"),
        "pct_n": F.count("percentage"),
        "earned": F.sum("score"),
        "possible": F.sum("points_possible"),
        "late": F.count_if("late_flag"),
        "missing": F.count_if("missing_flag"),
    }
    if not compat:
        return marks.groupBy(*PAIR).agg(*[e.alias(c) for c, e in sums.items()])
    per_assignment = marks.groupBy(*PAIR, "assignment_id").agg(
        *[e.alias(c) for c, e in sums.items()], F.count(F.lit(1)).alias("rows")
    )
    return per_assignment.groupBy(*PAIR).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count(F.lit(1)).alias("submitted_assignments"), F.sum("rows").alias("rows"),
    )


def student_course_performance(students: DataFrame, enrollments: DataFrame, courses: DataFrame,
                               assignments: DataFrame, submissions: DataFrame, activity: DataFrame, *,
                               now: datetime, compat: bool = False) -> DataFrame:
    """One row per student, course, term and final grade.

    Submissions and activity are reduced to one row per student and course before they are joined.
    ``compat=True`` gives the sums of the plain six-table join, in which every submission repeats
    for every activity row and the other way round. Those factors are row counts per pair, so the
    repeated rows are counted and multiplied instead of produced.
    """
    group = (
        enrollments.select(*PAIR, "final_grade")
        .join(students.select("student_id"), "student_id", "left_semi")
        .join(offered_courses(courses, assignments), "course_id")
        .groupBy(*PAIR, "term", "final_grade", "total_assignments")
        .agg(F.count(F.lit(1)).alias("n_enrolled"))
    )
    acts = activity.groupBy(*PAIR).agg(
        F.sum("duration_seconds").alias("seconds"),
        F.max("activity_timestamp").alias("last_activity"),
        F.count(F.lit(1)).alias("n_activity"),
    )
    joined = group.join(_submission_totals(submissions, assignments, compat), PAIR, "left").join(acts, PAIR, "left")
    return performance_rows(joined, now=now, compat=compat)


def offered_courses(courses: DataFrame, assignments: DataFrame) -> DataFrame:
    """Term and number of assignments of each course."""
    per_course = assignments.groupBy("course_id").agg(F.count("assignment_id").alias("n_assignments"))
    return courses.select("course_id", "term").join(per_course, "course_id", "left").select(
        "course_id", "term", F.coalesce("n_assignments", F.lit(0)).alias("total_assignments")
    )


def performance_rows(joined: DataFrame, *, now: datetime, compat: bool = False) -> DataFrame:
    """The columns of the rollup from the totals of each student and course."""
    zero = F.lit(0)
    seconds = F.col("seconds")
    times = F.lit(1)
    if compat:
        times = F.col("n_enrolled") * F.greatest(F.coalesce("n_activity", zero), F.lit(1))
        sub_rows = (
            F.col("total_assignments") - F.coalesce("submitted_assignments", zero) + F.coalesce("rows", zero)
        )
        seconds = seconds * F.col("n_enrolled") * F.greatest(sub_rows, F.lit(1))
    return joined.select(
        "student_id", "course_id", "term",
        F.col("total_assignments").cast("bigint"),
        F.coalesce("completed", zero).cast("bigint").alias("completed_assignments"),
        ratio(F.col("pct_sum"), F.col("pct_n"), 2).cast("decimal(5,2)").alias("avg_score"),
        (F.col("earned") * times).cast("decimal(20,2)").alias("total_points_earned"),
        (F.col("possible") * times).cast("decimal(20,2)").alias("total_points_possible"),
        F.coalesce(F.col("late") * times, zero).cast("bigint").alias("late_submissions"),
        F.coalesce(F.col("missing") * times, zero).cast("bigint").alias("missing_submissions"),
        F.coalesce(half_up_minutes(seconds), zero).cast("bigint").alias("total_activity_minutes"),
        F.to_date("last_activity").alias("last_activity_date"),
        F.col("final_grade").alias("current_grade"),
        F.lit(now).cast("timestamp_ntz").alias("calculated_at"),
    )


def grade_counts():
    """One count per grade band, in band order."""
    return {band: count_where(F.col("final_grade").isin(*grades)) for band, grades in GRADE_BANDS.items()}


def grade_distribution(enrollments: DataFrame, *dims: str) -> DataFrame:
    return enrollments.groupBy(*dims).agg(
        F.struct(*[c.alias(b) for b, c in grade_counts().items()]).alias("grade_distribution")
    )


def course_analytics(courses: DataFrame, enrollments: DataFrame, activity: DataFrame, *, now: datetime,
                     at_risk_below: int = 60) -> DataFrame:
    """One row per course with enrollments.

    Enrollments and activity are both reduced to student and course first. That makes the distinct
    student counts plain counts, and lets the two sides join on the partitioning they already have.
    The exact median comes from counts per score, so no score list is ever held for a course.
    """
    state = F.col("enrollment_state")
    pair = enrollments.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(state == "active").alias("active"),
        F.sum("final_score").alias("score_sum"),
        F.count("final_score").alias("score_n"),
        count_where(state == "completed").alias("completed"),
        count_where(F.col("final_score") < at_risk_below).alias("at_risk"),
        *[c.alias(f"grade_{b}") for b, c in grade_counts().items()],
    ).join(engagement_minutes(activity), PAIR, "left")
    medians = (
        enrollments.where(F.col("final_score").isNotNull())
        .groupBy("course_id", "final_score").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("course_id").agg(F.percentile("final_score", 0.5, F.col("n")).alias("median"))
    )
    return course_rows(courses, pair, medians, now=now)


def course_rows(courses: DataFrame, pair: DataFrame, medians: DataFrame, *, now: datetime) -> DataFrame:
    """The columns of the course rollup from the counts of each student and course, and the courses' medians."""
    known = F.col("student_id").isNotNull()
    minutes = F.col("total_minutes")
    per_course = pair.groupBy("course_id").agg(
        count_where(known).alias("total_enrolled"),
        count_where(known & F.col("active")).alias("active_students"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("score_n").alias("score_n"),
        F.sum("rows").alias("rows"),
        F.sum("completed").alias("completed"),
        F.sum("at_risk").alias("at_risk"),
        F.sum(minutes * F.col("rows")).alias("minutes_sum"),
        F.sum(F.when(minutes.isNotNull(), F.col("rows"))).alias("minutes_n"),
        *[F.sum(f"grade_{b}").alias(f"grade_{b}") for b in GRADE_BANDS],
    )
    return (
        courses.select("course_id", "term").join(per_course, "course_id").join(medians, "course_id", "left")
        .select(
            "course_id", "term",
            F.col("total_enrolled").cast("bigint"),
            F.col("active_students").cast("bigint"),
            ratio(F.col("score_sum"), F.col("score_n"), 2).cast("decimal(5,2)").alias("avg_class_score"),
            F.round(F.col("median").cast("decimal(12,4)"), 2).cast("decimal(5,2)").alias("median_class_score"),
            F.struct(*[F.col(f"grade_{b}").alias(b) for b in GRADE_BANDS]).alias("grade_distribution"),
            ratio(F.col("completed"), F.col("rows"), 2, times=100).cast("decimal(5,2)").alias("completion_rate"),
            ratio(F.col("minutes_sum"), F.col("minutes_n"), 0).cast("bigint").alias("avg_engagement_minutes"),
            F.col("at_risk").cast("bigint").alias("at_risk_students"),
            F.lit(now).cast("timestamp_ntz").alias("calculated_at"),
        )
    )


def student_risk(performance: DataFrame, *, score: float = 70, late: int = 5, missing: int = 3) -> DataFrame:
    """Students over any of the three limits across all their courses."""
    return performance.groupBy("student_id").agg(
        mean(F.sum("avg_score"), F.count("avg_score")).alias("overall_avg_score"),
        F.sum("late_submissions").alias("total_late"),
        F.sum("missing_submissions").alias("total_missing"),
        mean(F.sum("total_activity_minutes"), F.count("total_activity_minutes")).alias("avg_activity"),
    ).where((F.col("overall_avg_score") < score) | (F.col("total_late") > late) | (F.col("total_missing") > missing))
