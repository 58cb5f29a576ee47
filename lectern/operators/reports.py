"""Ready-made analytic queries over the curated tables and base views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.scalars import full_name, ratio
from lectern.operators.metrics import ENROLLMENT_MODEL, STUDENT_MODEL, SUBMISSION_MODEL, metric_query


def _mean(column: str, scale: int):
    return ratio(F.sum(column), F.count(column), scale)


def enrollment_detail(enrollments: DataFrame, students: DataFrame, courses: DataFrame) -> DataFrame:
    return enrollments.join(
        students.select("student_id", full_name().alias("student_name")), "student_id"
    ).join(courses.select("course_id", "course_code", "course_name"), "course_id").select(
        "enrollment_id", "student_name", "course_code", "course_name", "enrollment_state", "final_grade",
        "final_score",
    )


def performance_by_major(students: DataFrame, performance: DataFrame) -> DataFrame:
    """Counts student and course pairs: a student appears once per course, and once without any.

    Performance is reduced to one row per student first, so the join stays one to one.
    """
    per_student = performance.groupBy("student_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("avg_score").alias("score_sum"), F.count("avg_score").alias("score_n")
    )
    pairs = F.coalesce("pairs", F.lit(1))
    return students.join(per_student, "student_id", "left").groupBy("major").agg(
        F.sum(pairs).alias("student_count"),
        ratio(F.sum(F.col("gpa") * pairs), F.sum(F.when(F.col("gpa").isNotNull(), pairs)), 2).alias("avg_gpa"),
        ratio(F.sum("score_sum"), F.sum("score_n"), 1).alias("avg_course_score"),
    ).orderBy(F.desc("avg_gpa"), "major")


def course_report(analytics: DataFrame, courses: DataFrame) -> DataFrame:
    return analytics.join(courses.select("course_id", "course_code", "course_name"), "course_id").select(
        "course_id", "course_code", "course_name", "total_enrolled", "active_students", "avg_class_score",
        "completion_rate", "at_risk_students",
    ).orderBy(F.desc("total_enrolled"), "course_id")


def at_risk_students(students: DataFrame, performance: DataFrame, *, score: float = 70, late: int = 3,
                     missing: int = 2) -> DataFrame:
    """Student and course pairs over any one limit."""
    flagged = performance.where(
        (F.col("avg_score") < score) | (F.col("late_submissions") > late) | (F.col("missing_submissions") > missing)
    )
    return flagged.join(
        students.select("student_id", full_name().alias("student_name"), "major", "gpa"), "student_id"
    ).select(
        "student_id", "course_id", "student_name", "major", "gpa", "avg_score", "late_submissions",
        "missing_submissions", "current_grade",
    ).orderBy("avg_score", "student_id", "course_id")


def top_courses(enrollments: DataFrame, courses: DataFrame, n: int = 10) -> DataFrame:
    """Grouped by code, name and department; ties are broken by them."""
    per_course = enrollments.groupBy("course_id").agg(F.count(F.lit(1)).alias("n"))
    return per_course.join(courses, "course_id").groupBy("course_code", "course_name", "department").agg(
        F.sum("n").alias("enrollment_count")
    ).orderBy(F.desc("enrollment_count"), "course_code", "course_name", "department").limit(n)


def enrollment_sample(enrollments: DataFrame, courses: DataFrame, n: int = 10) -> DataFrame:
    return enrollments.join(courses.select("course_id", "course_code", "course_name", "department"), "course_id", "left").select(
        "enrollment_id", "student_id", "course_id", "course_code", "course_name", "department"
    ).orderBy("enrollment_id").limit(n)


def students_by_major(students: DataFrame, n: int = 10) -> DataFrame:
    return students.groupBy("major").agg(
        F.count(F.lit(1)).alias("student_count"), _mean("gpa", 2).alias("avg_gpa"),
        F.count_if(F.col("gpa") < 2.0).alias("at_risk_count"),
        F.count_if(F.col("gpa") >= 3.5).alias("deans_list_count"),
    ).orderBy(F.desc("student_count"), "major").limit(n)


def courses_by_department(courses: DataFrame, n: int = 10) -> DataFrame:
    return courses.groupBy("department").agg(
        F.count(F.lit(1)).alias("course_count"), F.sum("credit_hours").alias("total_credits"),
        F.countDistinct("instructor_name").alias("instructor_count"),
    ).orderBy(F.desc("course_count"), "department").limit(n)


def enrollments_by_term(enrollments: DataFrame, n: int = 20) -> DataFrame:
    """Over the enrollment base view."""
    return enrollments.where(F.col("term").isNotNull()).groupBy("term", "department").agg(
        F.count(F.lit(1)).alias("enrollment_count"), F.countDistinct("student_id").alias("unique_students"),
        _mean("grade_points", 2).alias("avg_grade_points"),
    ).orderBy(F.desc("term"), F.desc("enrollment_count"), "department").limit(n)


def submissions_by_type(submissions: DataFrame) -> DataFrame:
    """Over the submission base view."""
    return submissions.where(F.col("assignment_type").isNotNull()).groupBy("assignment_type").agg(
        F.count(F.lit(1)).alias("submission_count"), _mean("percentage", 1).alias("avg_percentage"),
        F.count_if("late_flag").alias("late_count"),
    ).orderBy(F.desc("submission_count"), "assignment_type")


def performance_by_dept(performance: DataFrame, n: int = 20) -> DataFrame:
    """Over the performance base view."""
    return performance.where(F.col("term").isNotNull()).groupBy("department", "term").agg(
        F.count(F.lit(1)).alias("record_count"), _mean("average_score", 1).alias("avg_score"),
        F.count_if(F.col("average_score") < 60).alias("at_risk"),
        F.count_if(F.col("average_score") >= 90).alias("high_performers"),
    ).orderBy(F.desc("term"), F.desc("record_count"), "department").limit(n)


def gpa_by_major(students: DataFrame) -> DataFrame:
    return metric_query(students, STUDENT_MODEL, ["average_gpa", "total_students"], ["major"])


def students_on_probation(students: DataFrame) -> DataFrame:
    return students.where(F.col("academic_standing") == "Academic Probation").select(
        "student_id", "full_name", "major", "gpa"
    )


def most_active_instructors(courses: DataFrame, n: int = 10) -> DataFrame:
    return courses.groupBy("instructor_name").agg(
        F.count("course_id").alias("total_courses"), F.sum("credit_hours").alias("total_credit_hours")
    ).orderBy(F.desc("total_courses"), "instructor_name").limit(n)


def late_rate_by_type(submissions: DataFrame) -> DataFrame:
    counts = metric_query(submissions, SUBMISSION_MODEL, ["total_submissions", "late_submission_count"],
                          ["assignment_type"])
    return counts.withColumn(
        "late_rate_pct", ratio(F.col("late_submission_count"), F.col("total_submissions"), 2, times=100)
    )


def highest_enrollment(enrollments: DataFrame, n: int = 10) -> DataFrame:
    return metric_query(
        enrollments, ENROLLMENT_MODEL, ["total_enrollments"], ["course_id", "course_name"]
    ).orderBy(F.desc("total_enrollments"), "course_id").limit(n)


def _state_rate(enrollments: DataFrame, state: str, dims: list[str], name: str) -> DataFrame:
    return enrollments.groupBy(*dims).agg(
        F.count("enrollment_id").alias("total_enrollments"),
        F.count_if(F.col("enrollment_status") == state).alias(f"{state}_count"),
    ).withColumn(name, ratio(F.col(f"{state}_count"), F.col("total_enrollments"), 2, times=100))


def completion_by_department(enrollments: DataFrame) -> DataFrame:
    return _state_rate(enrollments, "completed", ["department"], "completion_rate_pct")


def dropout_rate(enrollments: DataFrame, n: int = 10) -> DataFrame:
    """Courses with the highest share of dropped enrollments."""
    return _state_rate(enrollments, "dropped", ["course_id", "course_name"], "dropout_rate_pct").orderBy(
        F.desc("dropout_rate_pct"), F.desc("total_enrollments"), "course_id"
    ).limit(n)


def enrollment_by_classification(enrollments: DataFrame) -> DataFrame:
    return metric_query(enrollments, ENROLLMENT_MODEL, ["total_enrollments", "unique_students"],
                        ["student_classification"])


def term_trend(enrollments: DataFrame, last_terms: int = 3) -> DataFrame:
    """Enrollments of the last terms, ordered by the first enrollment day of each term."""
    return enrollments.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.min("enrollment_date").alias("first_enrolled"),
        F.count("enrollment_id").alias("total_enrollments"),
        F.countDistinct("student_id").alias("unique_students"),
    ).orderBy(F.desc("first_enrolled"), F.desc("term")).limit(last_terms)


def top_students_by_department(enrollments: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` students with the highest mean final score in each department's courses."""
    means = enrollments.where(F.col("final_score").isNotNull() & F.col("department").isNotNull()).groupBy(
        "department", "student_id"
    ).agg(_mean("final_score", 2).alias("avg_final_score"), F.count("final_score").alias("graded_courses"))
    order = W.partitionBy("department").orderBy(F.desc("avg_final_score"), F.desc("graded_courses"), "student_id")
    return means.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def pass_rate(enrollments: DataFrame, passing_score: int = 60) -> DataFrame:
    """Share of graded enrollments at or above the passing score, per department."""
    score = F.col("final_score")
    return enrollments.groupBy("department").agg(
        F.count("final_score").alias("graded"), F.count_if(score >= passing_score).alias("passed")
    ).withColumn("pass_rate_pct", ratio(F.col("passed"), F.col("graded"), 2, times=100))
