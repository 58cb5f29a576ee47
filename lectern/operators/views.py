"""Base views: curated tables with computed and joined columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.scalars import (
    academic_standing, full_name, grade_category, grade_points, ratio, score_category,
)


def students_base(students: DataFrame) -> DataFrame:
    return students.select(
        "student_id", "canvas_user_id", "first_name", "last_name", full_name().alias("full_name"), "email", "major",
        "classification", "enrollment_status", "enrollment_date", "expected_graduation", "gpa", "advisor_id",
        academic_standing(F.col("gpa")).alias("academic_standing"), "created_at", "updated_at",
    )


def courses_base(courses: DataFrame) -> DataFrame:
    return courses.select(
        "course_id", "canvas_course_id", "course_code", "course_name", "department", "credit_hours", "course_level",
        "delivery_mode", "term", "academic_year", "instructor_id", "instructor_name", "start_date", "end_date",
        "max_enrollment", "is_current", "created_at",
    )


def _student_names(students: DataFrame, *cols) -> DataFrame:
    """What a view shows of a student; the full name is made of the parts when no join is left that would carry it."""
    return students.select(
        "student_id", F.col("first_name").alias("student_first_name"), F.col("last_name").alias("student_last_name"), *cols,
    )


def _student_name():
    return full_name("student_first_name", "student_last_name").alias("student_name")


def enrollments_base(enrollments: DataFrame, students: DataFrame, courses: DataFrame) -> DataFrame:
    score = F.col("final_score")
    names = _student_names(students, F.col("major").alias("student_major"),
                           F.col("classification").alias("student_classification"))
    offered = courses.select("course_id", "course_code", "course_name", "department", "term", "instructor_name",
                             "credit_hours")
    return enrollments.join(names, "student_id", "left").join(offered, "course_id", "left").select(
        "enrollment_id", "student_id", "course_id", F.col("enrolled_at").alias("enrollment_date"),
        F.col("enrollment_state").alias("enrollment_status"), "final_grade", "final_score",
        grade_points(score).alias("grade_points"), grade_category(score).alias("grade_category"),
        "student_first_name", "student_last_name", _student_name(), "student_major", "student_classification",
        "course_code", "course_name", "department", "term", "instructor_name", "credit_hours", "created_at",
    )


def submissions_base(submissions: DataFrame, assignments: DataFrame, students: DataFrame) -> DataFrame:
    names = _student_names(students, F.col("major").alias("student_major"))
    tasks = assignments.select("assignment_id", "assignment_name", "assignment_type", "points_possible", "due_date",
                               "course_id")
    # The narrow names come first: the second join carries what the first one added.
    return submissions.drop("points_possible").join(names, "student_id", "left").join(
        tasks, "assignment_id", "left"
    ).select(
        "submission_id", "assignment_id", "student_id", F.col("submitted_at").alias("submission_date"), "score",
        "grade", "late_flag", "attempt_number", "graded_at", "grader_id", "percentage", "assignment_name",
        "assignment_type", "points_possible", "due_date", "course_id",
        score_category(F.col("percentage")).alias("score_category"),
        "student_first_name", "student_last_name", _student_name(), "student_major", "created_at",
    )


def performance_base(performance: DataFrame, students: DataFrame, courses: DataFrame) -> DataFrame:
    names = _student_names(students, "major", "classification", F.col("gpa").alias("overall_gpa"))
    offered = courses.select("course_id", "course_code", "course_name", "department", "instructor_name")
    done = F.when(
        F.col("total_assignments") > 0,
        ratio(F.col("completed_assignments"), F.col("total_assignments"), 1, times=100),
    ).otherwise(F.lit(0)).cast("decimal(10,1)")
    return performance.join(names, "student_id", "left").join(offered, "course_id", "left").select(
        "student_id", "course_id", "term", "total_assignments", "completed_assignments",
        F.col("avg_score").alias("average_score"), "total_points_earned", "total_points_possible",
        "late_submissions", "missing_submissions", "total_activity_minutes",
        F.col("current_grade").alias("performance_grade"), "last_activity_date", "calculated_at",
        done.alias("completion_rate"), "student_first_name", "student_last_name", _student_name(), "major",
        "classification", "overall_gpa", "course_code", "course_name", "department", "instructor_name",
    )
