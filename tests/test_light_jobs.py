"""Jobs and views at size: what is joined, stored and left behind."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from lectern.operators import upsert, views
from lectern.plans import catalog, jobs
from lectern.plans.constraints import Constraints
from lectern.plans.rollups import Rollups
from lectern.schemas import ENTITIES
from lectern.sources import testbed
from lectern.sources.changes import AFTER, BEFORE, INSERT, ChangeLog
from lectern.sources.store import Lake

NOW = datetime(2024, 2, 1)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().endswith(".data") for i in range(files.size()))


def curated_rows(spark, *rows):
    """Stored submissions from (key, surrogate, month, score)."""
    spec = ENTITIES["submissions"]
    given = {"submission_id": lambda r: r[0], "submission_key": lambda r: r[1], "submitted_at": lambda r: datetime(2024, r[2], 1)}
    df = spark.createDataFrame([(r[0], r[1], datetime(2024, r[2], 1), r[3]) for r in rows],
                               "submission_id string, submission_key bigint, submitted_at timestamp_ntz, score int")
    return df.select(*[(F.col(c) if c in (*given, "score") else F.lit(None)).cast(t).alias(c) for c, t in spec.columns])


def feed(spark, *rows):
    df = curated_rows(spark, *[(k, None, m, s) for k, m, s in rows])
    return df.select(*ENTITIES["submissions"].fields, *ENTITIES["submissions"].lookups)


def stored(lake, *rows):
    spec = ENTITIES["submissions"]
    df = curated_rows(lake.spark, *rows).withColumn("part", jobs.month_of(spec.partition_time))
    lake.replace(f"curated/{spec.table}", df, "part")


def logged(lake):
    rows = jobs.change_log(lake, "submissions").read().collect()
    return sorted((r.submission_id, r.change, int(r.score)) for r in rows)


def test_a_job_leaves_no_shuffle_files(spark, sf_dir):
    """each execution removes its own; they used to stay until the driver collected garbage."""
    spark._jvm.System.gc()
    catalog.queries()["job_relanded_batch"](spark, sf_dir)
    held = shuffle_files(spark)
    catalog.queries()["job_relanded_batch"](spark, sf_dir)
    assert shuffle_files(spark) <= held
    catalog.queries()["students_base"](spark, sf_dir)
    assert spark.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold") in ("0", "0b")


def test_a_merge_joins_once(spark, tmp_path, monkeypatch):
    """F2 to F7: one join on the key tells new rows from changed ones; there used to be four more."""
    lake, plans, prepare = Lake(spark, str(tmp_path)), [], ChangeLog.prepare
    monkeypatch.setattr(ChangeLog, "prepare", lambda self, rows: plans.append(optimized(rows)) or prepare(self, rows))
    stored(lake, ("a", 1, 1, 10), ("b", 2, 1, 20), ("c", None, 2, 30))
    jobs.merge_table(lake, ENTITIES["submissions"], feed(spark, ("a", 1, 11), ("c", 2, 31), ("d", 3, 40)), now=NOW)
    assert logged(lake) == [("a", AFTER, 11), ("a", BEFORE, 10), ("c", AFTER, 31), ("c", BEFORE, 30), ("d", INSERT, 40)]
    # A stored row without a number is a changed row all the same, and gets one.
    assert all(r.submission_key for r in jobs.curated(lake, "submissions").collect())
    jobs.merge_table(lake, ENTITIES["submissions"], feed(spark, ("e", 1, 50)), now=NOW)
    joins = [len(re.findall(r"Join ", p)) for p in plans]
    assert joins == [1, 0]
    got = {(r.submission_id, int(r.score)) for r in jobs.curated(lake, "submissions").collect()}
    assert got == {("a", 11), ("b", 20), ("c", 31), ("d", 40), ("e", 50)}
    assert not lake._exists(f"{lake.root}/staging/before/fact_submissions")


def test_a_merge_over_keys_stored_twice(spark, tmp_path):
    """Copies of a stored key multiply as they did."""
    lake = Lake(spark, str(tmp_path))
    stored(lake, ("a", 1, 1, 10), ("a", 2, 1, 20), ("b", 3, 1, 30))
    jobs.merge_table(lake, ENTITIES["submissions"], feed(spark, ("a", 1, 11), ("b", 1, 31)), now=NOW)
    assert logged(lake) == sorted([("a", AFTER, 11)] * 4 + [("a", BEFORE, 10), ("a", BEFORE, 20), ("b", AFTER, 31), ("b", BEFORE, 30)])


def test_no_rows_are_known_to_be_none(spark, tmp_path):
    """F2, F4 to F6: a first load does not shuffle its rows to meet an empty table."""
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(5).select(F.col("id").cast("string").alias("k"))
    assert "Join" not in optimized(rows.join(lake.read("none", "k string"), "k", "left_anti"))
    assert "Join" not in optimized(rows.join(lake.empty("k string, v int"), "k", "full_outer"))


def test_whole_rollups_are_not_joined_with_all_groups(spark, tmp_path):
    """a whole result used to join each state with the distinct groups of that state."""
    lake = Lake(spark, str(tmp_path))
    rollups = Rollups(lake, buckets=2)
    rollups.follow()
    plans = [rollups.performance_of(None, None, now=NOW), rollups.analytics_of(None, None, now=NOW)]
    semi = [p._jdf.queryExecution().analyzed().toString().count("Join LeftSemi") for p in plans]
    assert semi == [1, 0]


def test_counts_of_news_are_written_once(spark, tmp_path):
    """the counts lie where they are listed; they used to be written to a staging folder and again from there."""
    lake = Lake(spark, str(tmp_path))
    lake.replace("curated/dim_students", spark.createDataFrame([("U1", 1), ("U1", 2)], "student_id string, student_key bigint").select(
        *[(F.col(c) if c in ("student_id", "student_key") else F.lit(None)).cast(t).alias(c) for c, t in ENTITIES["students"].columns]))
    Constraints(lake, buckets=4).refresh()
    assert not lake._exists(f"{lake.root}/staging/constraints")
    report = {(r.table_name, r.constraint_type): r.violations for r in Constraints(lake).report().where("table_name = 'dim_students'").collect()}
    assert report == {("dim_students", "NOT_NULL"): 0, ("dim_students", "UNIQUE"): 1}


def test_a_feed_meets_its_dimensions_without_stale_copies(spark, sf_dir):
    """F8, F10: each key reaches the lookups once; the stale copy of every row used to travel with it."""
    rows = catalog.resent(testbed.Testbed(spark, sf_dir), "submissions")
    assert rows.groupBy("submission_id").count().where("count > 1").isEmpty()


def test_the_last_copy_travels_without_its_order_twice(spark):
    """F4 to F6, F8, F10: a row's place in the feed was shuffled among the values and again as what is compared."""
    rows = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 2, "y"), ("a", 3, 2, "x"), ("b", 9, None, None)],
                                 "id string, v int, ingested_at int, raw_id string")
    last = upsert.latest_per_key(rows, ["id"], keep_order=False)
    assert last.columns == ["id", "v"] and {tuple(r) for r in last.collect()} == {("a", 2), ("b", 9)}
    assert {tuple(r) for r in upsert.latest_per_key(rows, ["id"]).collect()} == {("a", 2, 2, "y"), ("b", 9, None, None)}


def test_views_carry_narrow_columns_through_joins(spark):
    """full names are put together after the joins, and assignments are joined after names."""
    empty = {e: spark.createDataFrame([], spec.schema) for e, spec in ENTITIES.items()}
    df = views.submissions_base(empty["submissions"], empty["assignments"], empty["students"])
    joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert "assignment_id" in joins[0] and "student_id" in joins[1]
    students = spark.createDataFrame([("U1", "A", "B"), ("U2", "A", None)], "student_id string, first_name string, last_name string").select(
        *[(F.col(c) if c in ("student_id", "first_name", "last_name") else F.lit(None)).cast(t).alias(c) for c, t in ENTITIES["students"].columns])
    taken = spark.createDataFrame([("U1",), ("U2",), ("U3",)], "student_id string").select(
        *[(F.col(c) if c == "student_id" else F.lit(None)).cast(t).alias(c) for c, t in ENTITIES["enrollments"].columns])
    names = {r.student_id: r.student_name for r in views.enrollments_base(taken, students, empty["courses"]).collect()}
    assert names == {"U1": "A B", "U2": None, "U3": None}
