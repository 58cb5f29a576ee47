"""Data-quality checks, constraint checks and record counts.

A check yields one row per offending record, and the log holds their number. Issue lists are never
gathered into one value, so a check may find any number of records.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lectern.schemas import ENTITIES

CHECKS = ("ORPHANED_ENROLLMENTS", "DUPLICATE_STUDENT_IDS", "INVALID_GPA_VALUES")


def _issues(found: DataFrame, check: str, record_id: str, details: Column) -> DataFrame:
    return found.select(F.lit(check).alias("check_name"), F.col(record_id).alias("record_id"),
                        F.to_json(details).alias("details"))


def orphaned_enrollments(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    found = enrollments.join(students.select("student_id"), "student_id", "left_anti")
    return _issues(found, CHECKS[0], "enrollment_id", F.struct("enrollment_id"))


def duplicate_students(students: DataFrame) -> DataFrame:
    found = students.groupBy("student_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return _issues(found, CHECKS[1], "student_id", F.struct("student_id", "copies"))


def invalid_gpa(students: DataFrame) -> DataFrame:
    found = students.where((F.col("gpa") < 0) | (F.col("gpa") > 4.0))
    return _issues(found, CHECKS[2], "student_id", F.struct("student_id", "gpa"))


def dq_issues(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """All offending records of the three checks."""
    return orphaned_enrollments(enrollments, students).unionByName(duplicate_students(students)).unionByName(
        invalid_gpa(students)
    )


def dq_report(issues: DataFrame, *, now: datetime, checks: Iterable[str] = CHECKS) -> DataFrame:
    """One log row per check, also for checks that found nothing."""
    counts = issues.groupBy("check_name").agg(F.count(F.lit(1)).alias("n"))
    names = issues.sparkSession.createDataFrame([(c,) for c in checks], "check_name string")
    return names.join(counts, "check_name", "left").select(
        "check_name", F.lit(now).cast("timestamp_ntz").alias("check_timestamp"),
        F.coalesce("n", F.lit(0)).alias("issues_found"),
    )


@dataclass(frozen=True)
class Check:
    """``value`` is an aggregate SQL expression; the check passes at or below ``threshold``."""

    name: str
    value: str
    threshold: float = 0


def dq_thresholds(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Evaluate all checks in one pass over ``df``.

    A check whose expression cannot be resolved fails with its error; the others still run.
    """
    good, bad = [], []
    for check in checks:
        try:
            df.agg(F.expr(check.value))
            good.append(check)
        except AnalysisException as e:
            bad.append((check.name, None, float(check.threshold), False, str(e)))
    schema = "name string, value double, threshold double, passed boolean, error string"
    out = df.sparkSession.createDataFrame(bad, schema) if bad else None
    if good:
        row = df.agg(*[F.expr(c.value).cast("double").alias(f"v{i}") for i, c in enumerate(good)])
        results = F.explode(F.array(*[
            F.struct(
                F.lit(c.name).alias("name"), F.col(f"v{i}").alias("value"),
                F.lit(float(c.threshold)).alias("threshold"),
                (F.coalesce(F.col(f"v{i}"), F.lit(0.0)) <= F.lit(float(c.threshold))).alias("passed"),
                F.lit(None).cast("string").alias("error"),
            ) for i, c in enumerate(good)
        ]))
        ran = row.select(results.alias("r")).select("r.*")
        out = ran if out is None else ran.unionByName(out)
    return out


def linkage_check(enrollments: DataFrame) -> DataFrame:
    """How many enrollments carry each id and each looked-up key."""
    return enrollments.agg(
        F.count(F.lit(1)).alias("total_enrollments"),
        F.count("course_id").alias("with_course_id"),
        F.count("course_key").alias("with_course_key"),
        F.count("student_id").alias("with_student_id"),
        F.count("student_key").alias("with_student_key"),
    ).select(F.lit("Enrollment Linkage Check").alias("check_name"), "*")


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of the declared keys of each entity.

    NOT_NULL and FOREIGN_KEY count rows, UNIQUE counts key values held by several rows. Each table is read once:
    a row becomes the values of its key and of the keys it refers to, each in the domain of the key. Counting
    roles per domain and value is one shuffle for all checks, behind a partial count, so a hot value is one row there.
    """
    roles = [(name, ENTITIES[name].key, name) for name in tables]
    roles += [(name, natural, dim) for name in tables for dim, natural in ENTITIES[name].lookups.values() if dim in tables]
    parts = []
    for name, df in tables.items():
        held = [
            F.struct(F.lit(i).alias("role"), F.lit(domain).alias("domain"), F.col(column).cast("string").alias("value"))
            for i, (table, column, domain) in enumerate(roles) if table == name
        ]
        parts.append(df.select(F.explode(F.array(*held)).alias("v")).select("v.*"))
    per_value = reduce(DataFrame.unionByName, parts).groupBy("domain", "value").agg(
        *[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(len(roles))]
    )
    given, checks = F.col("value").isNotNull(), []
    for i, (name, column, domain) in enumerate(roles):
        spec, n = ENTITIES[name], F.col(f"n{i}")
        if i < len(tables):
            checks.append((spec.table, column, "NOT_NULL", F.sum(F.when(~given, n))))
            checks.append((spec.table, column, "UNIQUE", F.count_if(given & (n > 1))))
        else:
            key = next(k for k, (table, _, _) in enumerate(roles) if table == domain)
            fk = next(f for f, (dim, natural) in spec.lookups.items() if (dim, natural) == (domain, column))
            checks.append((spec.table, fk, "FOREIGN_KEY", F.sum(F.when(given & (F.col(f"n{key}") == 0), n))))
    counts = per_value.agg(*[F.coalesce(v, F.lit(0)).alias(f"c{i}") for i, (_, _, _, v) in enumerate(checks)])
    found = F.explode(F.array(*[
        F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(k).alias("constraint_type"),
                 F.col(f"c{i}").alias("violations"))
        for i, (t, c, k, _) in enumerate(checks)
    ]))
    return counts.select(found.alias("r")).select("r.*")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(n).alias("table_name"), "record_count")
        for n, df in tables.items()
    ])


def data_summary(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same counts as one row, one column per table."""
    return spark.range(1).select(*[df.agg(F.count(F.lit(1))).scalar().alias(n) for n, df in tables.items()])


def submission_pairs(raw_enrollments: DataFrame, raw_assignments: DataFrame) -> DataFrame:
    """Distinct student and assignment pairs of landed enrollments and assignments, errors left out."""
    usable = F.col("processing_status") != "ERROR"
    read = lambda field: F.get_json_object("payload", f"$.{field}").alias(field)
    taken = raw_enrollments.where(usable).select(read("student_id"), read("course_id")).distinct()
    tasks = raw_assignments.where(usable).select(
        read("assignment_id"), read("course_id"),
        F.get_json_object("payload", "$.points_possible").try_cast("decimal(10,2)").alias("points_possible"),
    )
    return taken.join(tasks, "course_id").select("student_id", "assignment_id", "points_possible").distinct()
