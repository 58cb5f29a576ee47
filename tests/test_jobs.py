import json
from datetime import datetime

import pytest

from lectern.plans import jobs
from lectern.schemas import DQ_ISSUES_SCHEMA, DQ_LOG_SCHEMA, RUN_EVENT_SCHEMA
from lectern.sources import landing
from lectern.sources.store import Lake

NOW, LATER = datetime(2024, 2, 1), datetime(2024, 2, 2)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def land(lake, entity, batch, *rows, now=NOW):
    payloads = [(r if isinstance(r, str) else json.dumps(r),) for r in rows]
    landing.land(lake, entity, lake.spark.createDataFrame(payloads, "payload string"), batch, now=now)


def submission(i, score, at="2024-10-15T10:00:00Z", student="U1", assignment="A1"):
    return {"submission_id": f"S{i}", "student_id": student, "assignment_id": assignment, "submitted_at": at, "score": score}


def test_regenerate_end_to_end(lake):
    row = jobs.reset_and_regenerate(lake, now=NOW, students=30, courses=6, per_student=3, per_course=4, per_enrollment=2).first()
    assert (row.students, row.courses, row.assignments, row.enrollments, row.activity_logs) == (30, 6, 24, 90, 180)
    assert row.perf_aggregations == 90 and row.submissions > 250
    linked = jobs.curated(lake, "submissions")
    assert linked.where("student_key IS NULL OR assignment_key IS NULL").count() == 0
    assert linked.select("submission_key").distinct().count() == row.submissions
    jobs.reset(lake)
    assert jobs.summary(lake).first().students == 0


def test_second_batch_updates_only_its_months(lake):
    land(lake, "submissions", "b1", submission(1, 10), submission(2, 20, "2024-11-01T00:00:00Z"), submission(3, 30, None))
    assert jobs.process_entity(lake, "submissions", now=NOW) == 3
    keys = {r.submission_id: r.submission_key for r in jobs.curated(lake, "submissions").collect()}
    path = lake.path("curated/fact_submissions")
    november = set(lake._children(f"{path}/part=2024-11"))
    land(lake, "submissions", "b2", submission(1, 11, "2024-12-31T00:00:00Z"), submission(4, 40), now=LATER)
    assert jobs.process_entity(lake, "submissions", now=LATER) == 2
    rows = {r.submission_id: r for r in jobs.curated(lake, "submissions").collect()}
    assert {k: int(r.score) for k, r in rows.items()} == {"S1": 11, "S2": 20, "S3": 30, "S4": 40}
    assert rows["S1"].submitted_at == datetime(2024, 10, 15, 10) and rows["S1"].updated_at == LATER
    assert {k: rows[k].submission_key for k in keys} == keys and rows["S4"].submission_key > max(keys.values())
    assert set(lake._children(f"{path}/part=2024-11")) == november
    assert jobs.process_entity(lake, "submissions", now=LATER) == 0


def test_bad_rows_are_logged_and_the_rest_loads(lake):
    land(lake, "students", "b1", {"student_id": "U1"}, '{"student_id":"U2"', {"major": "x"})
    assert jobs.process_entity(lake, "students", now=NOW) == 3
    assert jobs.curated(lake, "students").count() == 1
    status = {r.processing_status: r["count"] for r in landing.raw_table(lake, "students").groupBy("processing_status").count().collect()}
    assert status == {"PROCESSED": 1, "ERROR": 2}
    land(lake, "students", "b2", {"student_id": "U3"})
    assert landing.raw_table(lake, "students").where("processing_status = 'PENDING'").count() == 1
    assert landing.pending_batches(lake, "students") == ["b2"]


def test_late_dimension_is_backfilled(lake):
    land(lake, "submissions", "b1", submission(1, 10), submission(2, 20, student="U9"))
    jobs.process_entity(lake, "submissions", now=NOW)
    land(lake, "students", "b1", {"student_id": "U1"})
    land(lake, "assignments", "b1", {"assignment_id": "A1"})
    jobs.process_all(lake, now=NOW)
    jobs.backfill_table(lake, "submissions")
    rows = {r.submission_id: (r.student_key, r.assignment_key) for r in jobs.curated(lake, "submissions").collect()}
    assert rows["S1"][0] is not None and rows["S2"][0] is None and rows["S2"][1] is not None


def test_activity_replay_adds_nothing(lake):
    log = {"activity_id": "X1", "student_id": "U1", "activity_timestamp": "2024-10-15T10:00:00Z", "duration_seconds": 5}
    land(lake, "activity_logs", "b1", log, log)
    land(lake, "activity_logs", "b2", {**log, "duration_seconds": 9})
    jobs.process_entity(lake, "activity_logs", now=NOW)
    land(lake, "activity_logs", "b3", {**log, "duration_seconds": 7, "activity_timestamp": "2025-01-01T00:00:00Z"})
    jobs.process_entity(lake, "activity_logs", now=NOW)
    assert jobs.curated(lake, "activity_logs").count() == 1


def test_named_jobs_are_logged(spark, lake, monkeypatch):
    land(lake, "students", "b1", {"student_id": "U1", "enrollment_status": "Active"})
    done = jobs.run_job(spark, "STUDENTS", root=lake.root, now=NOW).first()
    assert (done.status, done.message) == ("COMPLETED", "ETL STUDENTS completed. Records processed: 1")
    assert jobs.run_job(spark, "NOPE", root=lake.root, now=NOW).first().message == "Unknown job type: NOPE"
    again = jobs.run_transformation(spark, "student_dimension", root=lake.root, now=LATER, limit=3).first()
    assert again.message == "Transformation student_dimension completed. Records: 1"
    monkeypatch.setitem(jobs.JOBS, "COURSES", lambda lake, now: 1 / 0)
    assert jobs.run_job(spark, "COURSES", root=lake.root, now=NOW).first().message == "Error: division by zero"
    status = jobs.run_status(lake).first()
    assert (status.status, status.errors, status.running_jobs) == ("idle", 1, 0)
    assert lake.read("audit/run_events", RUN_EVENT_SCHEMA).count() == 6


def test_file_landing(spark, lake, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"student_id":"U1"}\nnot json\n')
    (tmp_path / "c.csv").write_text("student_id,gpa\nU2,3.5\n")
    landing.land(lake, "students", landing.read_json_lines(spark, str(tmp_path / "in")), "j", now=NOW)
    landing.land(lake, "students", landing.read_csv(spark, str(tmp_path / "c.csv"), "student_id string, gpa double"), "c", now=NOW)
    jobs.process_entity(lake, "students", now=NOW)
    assert {r.student_id: r.gpa for r in jobs.curated(lake, "students").collect()}.keys() == {"U1", "U2"}
    names = {r.file_name.rsplit("/", 1)[-1] for r in landing.raw_table(lake, "students").collect()}
    assert names == {"a.json", "c.csv"}


def test_failed_write_keeps_the_old_version(lake):
    lake.replace("t", lake.spark.range(3))
    with pytest.raises(Exception):
        lake.replace("t", lake.spark.range(3).selectExpr("CAST(raise_error('stop') AS bigint) AS id"))
    assert lake.read("t", "id bigint").count() == 3
    lake.replace("t", lake.read("t", "id bigint").where("id > 0"))
    assert lake.read("t", "id bigint").count() == 2


def test_old_versions_are_dropped_on_request(lake):
    for n in range(4):
        lake.replace("t", lake.spark.range(n))
    assert lake.versions("t") == [1, 2, 3, 4]
    assert lake.drop_old_versions("t", keep=2) == [1, 2] and lake.versions("t") == [3, 4]
    assert lake.read("t", "id bigint").count() == 3
    with pytest.raises(ValueError):
        lake.drop_old_versions("t", keep=0)


def test_landing_a_batch_again_replaces_it(lake):
    for _ in range(2):
        land(lake, "students", "b1", {"student_id": "U1"})
    assert jobs.process_entity(lake, "students", now=NOW) == 1
    assert lake._children(f"{lake.root}/staging/students") == []


def test_a_processed_batch_that_lands_again_is_loaded(lake):
    land(lake, "students", "b1", {"student_id": "U1"}, "torn")
    assert jobs.process_entity(lake, "students", now=NOW) == 2
    land(lake, "students", "b1", {"student_id": "U1"}, {"student_id": "U2"})
    assert landing.pending_batches(lake, "students") == ["b1"]
    assert landing.raw_table(lake, "students").where("processing_status = 'PENDING'").count() == 2
    assert jobs.process_entity(lake, "students", now=LATER) == 2
    assert jobs.curated(lake, "students").count() == 2
    assert lake.read("audit/rejected", landing.REJECTED_SCHEMA).count() == 0
    with pytest.raises(ValueError):
        land(lake, "students", "a/b", {"student_id": "U1"})


def test_a_retried_load_notes_each_row_once(lake, monkeypatch):
    land(lake, "students", "b1", {"student_id": "U1"}, "torn")
    real = lake.replace_partitions

    def fails(table, *args):
        if table == "audit/batch_log":
            raise RuntimeError("lost")
        real(table, *args)

    monkeypatch.setattr(lake, "replace_partitions", fails)
    with pytest.raises(RuntimeError):
        jobs.process_entity(lake, "students", now=NOW)
    monkeypatch.setattr(lake, "replace_partitions", real)
    assert jobs.process_entity(lake, "students", now=NOW) == 2
    log = lake.read("audit/batch_log", landing.BATCH_LOG_SCHEMA).first()
    assert (log.row_count, log.rejected_count) == (2, 1)
    assert lake.read("audit/rejected", landing.REJECTED_SCHEMA).count() == 1


def test_keys_grow_after_a_crash(lake, monkeypatch):
    land(lake, "submissions", "b1", submission(1, 10))
    jobs.process_entity(lake, "submissions", now=NOW)
    first = jobs.curated(lake, "submissions").first().submission_key
    top = lake.read("audit/top_keys", jobs.TOP_KEY_SCHEMA).first()
    assert (top.top, top.writing) == (first, False)
    lake.replace_partitions("audit/top_keys", lake.spark.createDataFrame([(0, True, "fact_submissions")], jobs.TOP_KEY_SCHEMA), "table")
    land(lake, "submissions", "b2", submission(2, 10, "2025-01-01T00:00:00Z"))
    jobs.process_entity(lake, "submissions", now=NOW)
    keys = {r.submission_id: r.submission_key for r in jobs.curated(lake, "submissions").collect()}
    assert keys["S2"] > keys["S1"] == first


def test_jobs_drop_old_versions(spark, lake):
    for n in range(4):
        land(lake, "students", f"b{n}", {"student_id": f"U{n}"})
        jobs.run_job(spark, "STUDENTS", root=lake.root, now=NOW)
    assert len(lake.versions("curated/dim_students")) == 2 and jobs.curated(lake, "students").count() == 4


def test_quality_log_grows_by_run(lake):
    land(lake, "enrollments", "b1", {"enrollment_id": "E1", "student_id": "U9"})
    jobs.process_entity(lake, "enrollments", now=NOW)
    for now in (NOW, LATER):
        got = {r.check_name: r.issues_found for r in jobs.check_quality(lake, now=now).collect()}
        assert got == {"ORPHANED_ENROLLMENTS": 1, "DUPLICATE_STUDENT_IDS": 0, "INVALID_GPA_VALUES": 0}
    jobs.check_quality(lake, now=LATER)
    issues, log = lake.read("audit/dq_issues", DQ_ISSUES_SCHEMA), lake.read("audit/dq_log", DQ_LOG_SCHEMA)
    assert issues.count() == 2 and log.count() == 6
    assert log.join(issues, ["check_name", "run"]).count() == 2


def test_trigger_is_noted(lake):
    jobs.log_trigger(lake, now=NOW)
    assert lake.read("audit/run_events", RUN_EVENT_SCHEMA).first().status == "TRIGGERED"
