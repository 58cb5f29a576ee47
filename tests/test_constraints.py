"""Constraint counts that follow change logs equal those over whole tables."""

import json
from datetime import datetime

from lectern.operators import quality
from lectern.plans import jobs
from lectern.plans.constraints import Constraints
from lectern.schemas import ENTITIES
from lectern.sources import landing
from lectern.sources.store import Lake

NOW = datetime(2024, 2, 1)


def load(lake, batch, **rows):
    for entity, found in rows.items():
        landing.land(lake, entity, lake.spark.createDataFrame([(json.dumps(r),) for r in found], "payload string"), batch, now=NOW)
    jobs.process_all(lake, now=NOW)


def follow(lake):
    """Refresh with a new object, as another process would; the report equals one over whole tables."""
    Constraints(lake, buckets=4, fan=2).refresh()
    got = Constraints(lake).report().collect()
    whole = quality.constraint_report({e: jobs.curated(lake, e) for e in ENTITIES}).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
    return {(r.table_name, r.column_name, r.constraint_type): r.violations for r in got}


def test_report_follows_batches(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert set(follow(lake).values()) == {0}
    rows = [{"enrollment_id": f"E{i}", "student_id": s, "course_id": "C1", "enrolled_at": "2024-01-01T00:00:00Z"}
            for i, s in enumerate(["U1", "U1", "U2", None, "U3"])]
    load(lake, "one", students=[{"student_id": "U1"}], enrollments=rows)
    got = follow(lake)
    assert got["fact_enrollments", "student_key", "FOREIGN_KEY"] == 2 and got["fact_enrollments", "course_key", "FOREIGN_KEY"] == 5
    # A late dimension row clears its orphans; nothing of the facts is landed.
    load(lake, "two", students=[{"student_id": "U2"}, {"student_id": "U1", "major": "Art"}], courses=[{"course_id": "C1"}])
    got = follow(lake)
    assert got["fact_enrollments", "student_key", "FOREIGN_KEY"] == 1 and got["fact_enrollments", "course_key", "FOREIGN_KEY"] == 0
    jobs.remove_rows(lake, "students", spark.createDataFrame([("U1",)], "student_id string"))
    assert follow(lake)["fact_enrollments", "student_key", "FOREIGN_KEY"] == 3
    before = Constraints(lake).held.live()
    assert follow(lake) and Constraints(lake).held.live() == before and len(before) <= 3
