from datetime import datetime
from decimal import Decimal

import pytest

from lectern.operators import quality, runlog
from lectern.schemas import RUN_EVENT_SCHEMA

NOW = datetime(2024, 2, 1)


def students(spark, *rows):
    return spark.createDataFrame(list(rows), "student_id string, gpa decimal(3,2)")


def test_gpa_bounds(spark):
    df = students(spark, ("a", Decimal("-0.01")), ("b", Decimal("4.01")), ("c", Decimal("4.00")), ("d", None), ("e", Decimal("0")))
    assert {r.record_id for r in quality.invalid_gpa(df).collect()} == {"a", "b"}


def test_report_lists_checks_that_found_nothing(spark):
    enrollments = spark.createDataFrame([("e1", "a"), ("e2", "zz")], "enrollment_id string, student_id string")
    issues = quality.dq_issues(enrollments, students(spark, ("a", Decimal("1"))))
    got = {r.check_name: r.issues_found for r in quality.dq_report(issues, now=NOW).collect()}
    assert got == {"ORPHANED_ENROLLMENTS": 1, "DUPLICATE_STUDENT_IDS": 0, "INVALID_GPA_VALUES": 0}


def test_thresholds_and_a_broken_check(spark):
    df = students(spark, ("a", Decimal("1")), ("b", None))
    rows = {r.name: r for r in quality.dq_thresholds(df, [
        quality.Check("nulls", "count_if(gpa IS NULL)", 1), quality.Check("rows", "count(*)", 1),
        quality.Check("broken", "sum(no_such_column)"), quality.Check("empty", "max(IF(gpa > 9, 1, NULL))"),
    ]).collect()}
    assert rows["nulls"].passed and not rows["rows"].passed and rows["rows"].value == 2 and rows["empty"].passed
    assert not rows["broken"].passed and "no_such_column" in rows["broken"].error


def test_constraints(spark):
    dim = spark.createDataFrame([("s1",), ("s1",), ("s2",), (None,)], "student_id string")
    facts = spark.createDataFrame([("e1", "s1", "c"), ("e2", "s9", "c"), ("e3", None, "c"), ("e4", "s9", "c")],
                                  "enrollment_id string, student_id string, course_id string")
    got = {(r.table_name, r.constraint_type, r.column_name): r.violations
           for r in quality.constraint_report({"students": dim, "enrollments": facts}).collect()}
    assert got["dim_students", "UNIQUE", "student_id"] == 1 and got["dim_students", "NOT_NULL", "student_id"] == 1
    assert got["fact_enrollments", "FOREIGN_KEY", "student_key"] == 2
    assert ("fact_enrollments", "FOREIGN_KEY", "course_key") not in got


def test_run_log(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    events = spark.createDataFrame([
        ("1", "STUDENTS", "STARTED", t(1), 0, None, None), ("1", "STUDENTS", "COMPLETED", t(2), 10, None, None),
        ("2", "STUDENTS", "STARTED", t(3), 0, None, None), ("2", "STUDENTS", "FAILED", t(3), 0, "boom", None),
        ("3", "STUDENTS", "STARTED", t(4), 0, None, None), ("4", "CONTAINER_ETL", "TRIGGERED", t(5), 0, None, None),
    ], RUN_EVENT_SCHEMA)
    runs = runlog.latest_runs(events)
    got = {r.run_id: (r.status, r.completed_at) for r in runs.collect()}
    assert got == {"1": ("COMPLETED", t(2)), "2": ("FAILED", t(3)), "3": ("STARTED", None), "4": ("TRIGGERED", None)}
    status = runlog.job_status(runs).first()
    assert (status.status, status.records_processed, status.errors, status.running_jobs) == ("running", 10, 1, 1)
    assert [r.run_id for r in runlog.recent_runs(runs, "STUDENTS", 2).collect()] == ["3", "2"]
    with pytest.raises(ValueError):
        runlog.run_event(spark, "9", "STUDENTS", "PAUSED", now=NOW)
    assert runlog.run_event(spark, "9", "X", "TRIGGERED", now=NOW, metadata={"a": 1}).first().metadata == '{"a": 1}'
