"""Rollups that follow change logs equal rollups over whole tables."""

import json
import random
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lectern.operators import aggregates
from lectern.plans import jobs
from lectern.plans.rollups import Rollups, exact_medians
from lectern.schemas import COURSE_ANALYTICS_SCHEMA, PERFORMANCE_SCHEMA
from lectern.sources import landing
from lectern.sources.store import Lake

NOW, LATER = datetime(2024, 2, 1), datetime(2024, 2, 2)
GRADES = ["A", "A-", "B", "C+", "D", "F", None]
FACTS = ("students", "enrollments", "courses", "assignments", "submissions", "activity_logs")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A lake with a first batch and its rollups."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("rollups") / "lake"))
    first_batch(lake, random.Random(1))
    refresh(lake)
    assert same(lake) > 0
    return lake


@pytest.fixture
def lake(loaded, tmp_path):
    shutil.copytree(loaded.root, tmp_path / "lake")
    return Lake(loaded.spark, str(tmp_path / "lake"))


def load(lake, batch, now, **rows):
    for entity, found in rows.items():
        landing.land(lake, entity, lake.spark.createDataFrame([(json.dumps(r),) for r in found], "payload string"), batch, now=now)
    return jobs.process_all(lake, now=now)


def enrollment(rng, i):
    return {"enrollment_id": f"E{i}", "student_id": rng.choice([f"U{i % 7}", f"U{i % 5}", None]), "course_id": f"C{i % 4}",
            "enrollment_state": rng.choice(["active", "completed", "dropped"]), "enrolled_at": f"2024-0{1 + i % 3}-01T00:00:00Z",
            "final_grade": rng.choice(GRADES), "final_score": rng.choice([None, 40, 59.5, 60, 77.25, 91])}


def submission(rng, i):
    return {"submission_id": f"S{i}", "student_id": f"U{i % 7}", "assignment_id": f"A{i % 9}", "submitted_at": "2024-02-03T00:00:00Z",
            "score": rng.choice([None, 5, 7.5]), "points_possible": rng.choice([None, 10]), "percentage": rng.choice([None, 50, 75.5]),
            "late_flag": rng.choice([True, False, None]), "missing_flag": rng.choice([True, False])}


def visit(rng, i):
    return {"activity_id": f"X{i}", "student_id": f"U{i % 7}", "course_id": f"C{i % 5}", "duration_seconds": rng.choice([None, 30, 100]),
            "activity_timestamp": f"2024-0{1 + i % 4}-1{i % 9}T00:00:00Z"}


def whole(lake):
    tables = {n: jobs.curated(lake, n) for n in FACTS}
    return (aggregates.student_course_performance(*tables.values(), now=NOW),
            aggregates.course_analytics(tables["courses"], tables["enrollments"], tables["activity_logs"], now=NOW))


def stored(lake):
    return (lake.read(f"curated/{jobs.PERFORMANCE}", PERFORMANCE_SCHEMA).drop("bucket"),
            lake.read(f"curated/{jobs.ANALYTICS}", COURSE_ANALYTICS_SCHEMA).drop("bucket"))


def same(lake):
    for got, wanted in zip(stored(lake), whole(lake)):
        rows = [sorted(map(str, df.drop("calculated_at").collect())) for df in (got, wanted)]
        assert rows[0] == rows[1]
    return len(rows[0])


def refresh(lake, now=NOW, **options):
    rollups = Rollups(lake, buckets=4, fan=2, **options)
    return rollups.refresh_performance(now=now), rollups.refresh_analytics(now=now)


def first_batch(lake, rng):
    load(lake, "b1", NOW, students=[{"student_id": f"U{i}"} for i in range(5)],
         courses=[{"course_id": f"C{i}", "term": "Fall"} for i in range(3)],
         assignments=[{"assignment_id": f"A{i}", "course_id": f"C{i % 4}"} for i in range(6)],
         enrollments=[enrollment(rng, i) for i in range(30)], submissions=[submission(rng, i) for i in range(40)],
         activity_logs=[visit(rng, i) for i in range(40)])


def test_every_batch_equals_a_whole_recompute(lake):
    rng = random.Random(2)
    # Moved scores, a grade that changes, new facts, and dimensions that come after their facts.
    load(lake, "b2", LATER, enrollments=[enrollment(rng, i) for i in (3, 4, 31)], submissions=[submission(rng, i) for i in (5, 41, 42)],
         activity_logs=[visit(rng, i) for i in (3, 41)])
    refresh(lake)
    same(lake)
    load(lake, "b3", LATER, students=[{"student_id": "U5"}, {"student_id": "U6"}],
         courses=[{"course_id": "C3", "term": "Fall"}, {"course_id": "C0", "term": "Spring"}],
         assignments=[{"assignment_id": f"A{i}", "course_id": f"C{i % 4}"} for i in (6, 7, 8)])
    for entity, column, ids in (("enrollments", "enrollment_id", ["E1", "E2", "E5"]), ("submissions", "submission_id", ["S2", "S7"]),
                                ("activity_logs", "activity_id", ["X1", "X39"]), ("students", "student_id", ["U2"])):
        jobs.remove_rows(lake, entity, lake.spark.createDataFrame([(i,) for i in ids], f"{column} string"))
    refresh(lake)
    same(lake)
    assert refresh(lake) == (0, 0)


def test_only_changed_groups_are_computed_and_touched_buckets_read(lake, monkeypatch):
    load(lake, "b2", LATER, courses=[{"course_id": "C1", "term": "Fall", "course_name": "new"}])
    assert refresh(lake) == (0, 0)
    before = {(r.student_id, r.course_id, r.current_grade): r.calculated_at for r in stored(lake)[0].collect()}
    load(lake, "b3", LATER, activity_logs=[{**visit(random.Random(3), 99), "student_id": "U1", "course_id": "C1"}])
    asked = []
    real = Rollups.rows
    monkeypatch.setattr(Rollups, "rows", lambda self, state, buckets=None: asked.append((state.name, buckets)) or real(self, state, buckets))
    counts = refresh(lake, now=LATER)
    groups = [k for k in before if k[:2] == ("U1", "C1")]
    assert counts == (len(groups), 1)
    after = {(r.student_id, r.course_id, r.current_grade): r.calculated_at for r in stored(lake)[0].collect()}
    assert {k for k in after if after[k] == LATER} == set(groups) and before.keys() == after.keys()
    read = [b for name, b in asked if name == "grades" and b is not None]
    assert read and all(len(b) == 1 for b in read)


def test_a_refresh_that_is_repeated_after_crashes(lake, monkeypatch):
    rng = random.Random(4)
    load(lake, "b2", LATER, enrollments=[enrollment(rng, i) for i in (3, 4, 31)], activity_logs=[visit(rng, 41)])
    for step, part in (("write_text", "/rollup/members/"), ("replace_partitions", jobs.PERFORMANCE), ("write_text", "/_consumers/")):
        real = getattr(lake, step)

        def fails(path, *args):
            if part in path:
                raise RuntimeError("lost")
            return real(path, *args)

        monkeypatch.setattr(lake, step, fails)
        with pytest.raises(RuntimeError):
            refresh(lake)
        monkeypatch.setattr(lake, step, real)
    refresh(lake)
    same(lake)


def test_incremental_run_after_a_whole_one(spark, lake):
    jobs.refresh_performance(lake, now=NOW)
    landing.land(lake, "enrollments", spark.createDataFrame([(json.dumps(enrollment(random.Random(5), 40)),)], "payload string"), "b2", now=LATER)
    assert jobs.run_job(spark, "INCREMENTAL", root=lake.root, now=LATER).first().status == "COMPLETED"
    same(lake)


def test_medians_from_counts(spark):
    rng = random.Random(6)
    scores = [(f"C{rng.randrange(20)}", round(rng.uniform(0, 100), 2)) for _ in range(400)] + [("one", 3.0)]
    rows = spark.createDataFrame([(c, str(s)) for c, s in scores], "course_id string, s string").select("course_id", F.col("s").cast("decimal(5,2)").alias("final_score"))
    got = {r.course_id: float(r["median"]) for r in exact_medians(rows.groupBy("course_id", "final_score").agg(F.count("*").alias("n"))).collect()}
    for course in {c for c, _ in scores}:
        mine = sorted(s for c, s in scores if c == course)
        assert got[course] == pytest.approx((mine[(len(mine) - 1) // 2] + mine[len(mine) // 2]) / 2, abs=1e-4)
