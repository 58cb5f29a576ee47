from datetime import datetime

import pytest

from lectern.operators import upsert
from lectern.schemas import ENTITIES

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
STUDENT = ENTITIES["students"]


def target(spark, *rows):
    return spark.createDataFrame([(k, v, first, T0, T0) for k, v, first in rows],
                                 "id string, v int, first int, created_at timestamp_ntz, updated_at timestamp_ntz")


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v int, first int")


def merged(t, s, **kw):
    out = upsert.upsert(t, s, keys=["id"], update_cols=["v"], now=T1, **kw)
    return {r.id: (r.v, r.first, r.created_at, r.updated_at) for r in out.collect()}


@pytest.mark.parametrize("small", [True, False])
def test_matched_inserted_and_kept_rows(spark, small):
    got = merged(target(spark, ("a", 1, 1), ("b", 2, 2)), source(spark, ("b", 20, 20), ("c", 30, 30)), stored_source=small)
    assert got == {"a": (1, 1, T0, T0), "b": (20, 2, T0, T1), "c": (30, 30, T1, T1)}


@pytest.mark.parametrize("small", [True, False])
def test_null_in_the_source_overwrites(spark, small):
    assert merged(target(spark, ("a", 1, 1)), source(spark, ("a", None, None)), stored_source=small)["a"][:2] == (None, 1)


@pytest.mark.parametrize("small", [True, False])
def test_upsert_is_idempotent(spark, small):
    t, s = target(spark, ("a", 1, 1), ("b", 2, 2)), source(spark, ("b", 20, 20), ("c", 30, 30))
    once = upsert.upsert(t, s, keys=["id"], update_cols=["v"], now=T1, stored_source=small)
    twice = upsert.upsert(once, s, keys=["id"], update_cols=["v"], now=T1, stored_source=small)
    assert sorted(once.collect()) == sorted(twice.collect())


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v int, ingested_at timestamp_ntz, raw_id string")


def test_last_copy_of_a_key_wins(spark):
    rows = batch(spark, ("a", 1, T0, "r1"), ("a", 2, T1, "r0"), ("a", 3, T1, "r2"), ("b", 9, T0, "r3"))
    assert {r.id: r.v for r in upsert.latest_per_key(rows, ["id"]).collect()} == {"a": 3, "b": 9}


def test_duplicate_key_can_fail_the_batch(spark):
    rows = batch(spark, ("a", 1, T0, "r1"), ("a", 2, T1, "r2"))
    with pytest.raises(Exception, match="duplicate key in batch: a"):
        upsert.latest_per_key(rows, ["id"], on_duplicate="error").collect()
    with pytest.raises(ValueError):
        upsert.latest_per_key(rows, ["id"], on_duplicate="first")


def test_insert_new_never_changes_rows_and_replays_safely(spark):
    t = target(spark, ("a", 1, 1))
    once = upsert.insert_new(t, source(spark, ("a", 5, 5), ("b", 6, 6)), keys=["id"], now=T1)
    again = upsert.insert_new(once, source(spark, ("a", 5, 5), ("b", 6, 6)), keys=["id"], now=T2)
    assert {r.id: r.v for r in again.collect()} == {"a": 1, "b": 6} and again.count() == 2


def test_append_repeats_replayed_rows(spark):
    assert upsert.append(target(spark, ("a", 1, 1)), source(spark, ("a", 1, 1))).count() == 2


def dims(spark, students, courses):
    return {"students": spark.createDataFrame(students, "student_id string, student_key bigint"),
            "courses": spark.createDataFrame(courses, "course_id string, course_key bigint")}


def test_late_dimension_is_backfilled(spark):
    facts = spark.createDataFrame([("e1", "s1", "c1"), ("e2", "s2", "c1"), ("e3", "s9", "c9")],
                                  "enrollment_id string, student_id string, course_id string")
    early = upsert.lookup_keys(facts, "enrollments", dims(spark, [("s1", 1)], [("c1", 7)]))
    assert {r.enrollment_id: r.student_key for r in early.collect()} == {"e1": 1, "e2": None, "e3": None}
    late = upsert.backfill_keys(early, "enrollments", dims(spark, [("s1", 99), ("s2", 2)], [("c1", 88)]))
    assert {r.enrollment_id: (r.student_key, r.course_key) for r in late.collect()} == {
        "e1": (1, 7), "e2": (2, 7), "e3": (None, None)}


def test_assigned_keys_are_unique_and_above_the_old_ones(spark):
    df = spark.range(1000).selectExpr("IF(id < 10, id + 1, NULL) AS k", "id")
    keys = [r.k for r in upsert.assign_keys(df.repartition(7), "k", df).collect()]
    assert len(set(keys)) == 1000 and sorted(keys)[:10] == list(range(1, 11))


def test_mark_touches_only_the_bound_ids(spark):
    raw = spark.createDataFrame([("1", "PENDING"), ("2", "PENDING"), ("3", "PROCESSED")], "raw_id string, processing_status string")
    ids = spark.createDataFrame([("1",)], "raw_id string")
    status = lambda df: {r.raw_id: r.processing_status for r in df.collect()}
    assert status(upsert.mark_processed(raw, ids)) == {"1": "PROCESSED", "2": "PENDING", "3": "PROCESSED"}
    assert status(upsert.mark_processed(raw)) == {"1": "PROCESSED", "2": "PROCESSED", "3": "PROCESSED"}
    assert status(upsert.mark_error(raw, ids))["1"] == "ERROR"


def test_profiles():
    assert "completed_at" in ENTITIES["enrollments"].update_cols() and "completed_at" not in ENTITIES["enrollments"].update_cols("sql")
    assert STUDENT.update_cols("sql") == STUDENT.updates
    with pytest.raises(ValueError):
        STUDENT.update_cols("other")
