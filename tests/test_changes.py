"""Segments, key indexes, membership filters, change logs and what a crash leaves."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lectern.plans import jobs
from lectern.schemas import ENTITIES
from lectern.sources import landing
from lectern.sources.changes import Consumer
from lectern.sources.keyindex import KeyIndex, Membership
from lectern.sources.segments import Segments
from lectern.sources.store import Lake

NOW, LATER = datetime(2024, 2, 1), datetime(2024, 2, 2)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def load(lake, entity, batch, rows, now=NOW):
    landing.land(lake, entity, lake.spark.createDataFrame([(json.dumps(r),) for r in rows], "payload string"), batch, now=now)
    return jobs.process_entity(lake, entity, now=now)


def submissions(ids, month, score=1):
    return [{"submission_id": f"S{i}", "student_id": "U1", "assignment_id": "A1", "submitted_at": f"2024-{month:02d}-05T00:00:00Z", "score": score} for i in ids]


def activity(ids, month):
    return [{"activity_id": f"X{i}", "student_id": "U1", "course_id": "C1", "activity_timestamp": f"2024-{month:02d}-05T00:00:00Z"} for i in ids]


def read_files(df):
    return df.inputFiles()


# segments


def test_segments_are_merged_by_levels(spark, lake):
    held = Segments(lake, "t", fan=3)
    for n in range(14):
        held.add(spark.range(n, n + 1), f"b{n}")
        held.merge("id bigint", lambda df: df.drop("seg").coalesce(1))
        assert sorted(r.id for r in held.read("id bigint").collect()) == list(range(n + 1))
    levels = [s.level for s in held.live()]
    assert levels == sorted(levels, reverse=True) and max(levels) == 2 and len(levels) <= 2 * 3
    assert len(lake._children(f"{held.base}/lists")) <= 4 and len(lake._children(f"{held.base}/segments")) <= len(levels) + 3


def test_an_addition_that_is_repeated_counts_once(spark, lake):
    held = Segments(lake, "t")
    for rows in (3, 5):
        held.add(spark.range(rows), "batch-7")
    assert held.read("id bigint").count() == 5
    with pytest.raises(FileExistsError):
        lake.write_text(f"{held.base}/lists/{2:012d}.json", "{}")
    with pytest.raises(ValueError):
        Segments(lake, "t", fan=1)


def test_a_list_is_complete_or_missing(spark, lake, monkeypatch):
    held = Segments(lake, "t")
    held.add(spark.range(2), "a")
    monkeypatch.setattr(lake, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        held.add(spark.range(9), "b")
    assert held.read("id bigint").count() == 2


# month index and filters


def fact_of(spark, ids, months):
    rows = spark.createDataFrame([(f"K{i}", months[i % len(months)]) for i in ids] , "k string, part string")
    return rows


def test_key_index_reads_only_its_buckets(spark, lake):
    index = KeyIndex(lake, "curated/f", "k", buckets=16)
    months = ["2024-01", "2024-02", "2024-03"]
    assert index.ensure(fact_of(spark, range(400), months)) and not index.ensure(fact_of(spark, [], months))
    for n in range(5):
        index.add(fact_of(spark, range(400 + 10 * n, 410 + 10 * n), months), f"b{n}")
    keys = spark.createDataFrame([("K7",), ("K444",), ("new",), (None,)], "k string")
    assert {(r.k, r.part) for r in index.months_of(keys).collect()} == {("K7", months[7 % 3]), ("K444", months[444 % 3])}
    buckets = {f.split("bucket=")[1].split("/")[0] for f in read_files(index.rows(keys))}
    assert len(buckets) <= 4
    assert KeyIndex(lake, "curated/f", "k", buckets=999).buckets == 16


def test_filters_know_every_key_and_few_others(spark, lake):
    held = Membership(lake, "curated/f", "k", fan=3)
    months = [f"2024-{m:02d}" for m in range(1, 5)]
    held.ensure(fact_of(spark, range(4000), months))
    for n in range(7):
        held.add(fact_of(spark, range(4000 + n * 40, 4040 + n * 40), months), f"b{n}")
    for i in (0, 1, 4002, 4279):
        assert months[i % 4] in held.months(spark.createDataFrame([(f"K{i}",)], "k string"))
    assert held.months(spark.createDataFrame([(None,)], "k string")) == []
    unknown = spark.range(2000).select(F.concat(F.lit("N"), "id").alias("k"))
    filters = held.segments.read(held.schema)
    assert len(held.segments.live()) <= 5 and filters.count() < 4280 // 4
    hits = sum(bool(held.months(unknown.where(f"pmod(hash(k), 20) = {n}"))) for n in range(20))
    assert hits <= 3


def test_index_is_rebuilt_when_the_fact_was_replaced(spark, lake):
    load(lake, "submissions", "b1", submissions([1, 2], 3))
    spec = ENTITIES["submissions"]
    name = f"curated/{spec.table}"
    moved = lake.read(name, jobs.table_schema(spec)).withColumns({"part": F.lit("2023-01"), "submitted_at": F.expr("TIMESTAMP_NTZ '2023-01-01'")})
    lake.replace(name, moved, "part")
    load(lake, "submissions", "b2", submissions([1], 9, score=8), now=LATER)
    rows = {r.submission_id: (r.part, int(r.score)) for r in lake.read(name, jobs.table_schema(spec)).collect()}
    assert rows == {"S1": ("2023-01", 8), "S2": ("2023-01", 1)}


def test_a_second_batch_reads_index_buckets_and_touched_months_only(lake, monkeypatch):
    for month in range(1, 4):
        load(lake, "submissions", f"b{month}", submissions(range(10 * month, 10 * month + 10), month))
    spec, seen = ENTITIES["submissions"], []
    real = lake.read
    monkeypatch.setattr(lake, "read", lambda table, schema, parts=None, *a: seen.append((table, parts)) or real(table, schema, parts, *a))
    load(lake, "submissions", "again", submissions([20, 21], 11, score=9) + submissions([99], 11), now=LATER)
    fact = [parts for table, parts in seen if table == f"curated/{spec.table}"]
    # Whole reads are only declared, for an index that would have to be built; what is read are months.
    assert [p for p in fact if p is not None] == [["2024-02"], ["2024-02"]]
    source = lake.spark.createDataFrame([("S20",), ("S21",), ("never",)], "submission_id string")
    files = read_files(jobs._stored_rows(lake, spec, source))
    assert files and all("part=2024-02" in f for f in files)
    rows = {r.submission_id: r.part for r in real(f"curated/{spec.table}", jobs.table_schema(spec)).collect()}
    assert rows["S20"] == "2024-02" and rows["S99"] == "2024-11" and len(rows) == 31


def test_new_activity_reads_no_month_that_cannot_hold_it(lake):
    for month in range(1, 4):
        load(lake, "activity_logs", f"b{month}", activity(range(10 * month, 10 * month + 10), month))
    spec = ENTITIES["activity_logs"]
    keys = lambda *ids: lake.spark.createDataFrame([(f"X{i}",) for i in ids], "activity_id string")
    assert read_files(jobs._stored_rows(lake, spec, keys(500, 501))) == []
    files = read_files(jobs._stored_rows(lake, spec, keys(20, 500)))
    assert files and all("part=2024-02" in f for f in files)
    load(lake, "activity_logs", "again", activity([20, 21, 77], 9))
    rows = {r.activity_id: r.part for r in lake.read(f"curated/{spec.table}", jobs.table_schema(spec)).collect()}
    assert len(rows) == 31 and rows["X20"] == "2024-02" and rows["X77"] == "2024-09"


# change log


def test_changes_of_a_fact(lake):
    load(lake, "submissions", "b1", submissions([1, 2, 3], 3))
    load(lake, "submissions", "b2", submissions([2], 5, score=7) + submissions([4], 5), now=LATER)
    assert jobs.remove_rows(lake, "submissions", lake.spark.createDataFrame([("S3",), ("S9",)], "submission_id string")) == 1
    log = jobs.change_log(lake, "submissions")
    got = sorted((r.commit, r.change, r.submission_id, int(r.score)) for r in log.read().collect())
    assert got == [(1, "insert", "S1", 1), (1, "insert", "S2", 1), (1, "insert", "S3", 1), (2, "after", "S2", 7), (2, "before", "S2", 1),
                   (2, "insert", "S4", 1), (3, "delete", "S3", 1)]
    assert sorted((r.submission_id, r.n, int(r.score)) for r in log.net(after=1).collect()) == [
        ("S2", -1, 1), ("S2", 1, 7), ("S3", -1, 1), ("S4", 1, 1)]
    assert sorted(r.submission_id for r in jobs.curated(lake, "submissions").collect()) == ["S1", "S2", "S4"]


def test_removing_the_last_row_of_a_month(lake):
    load(lake, "submissions", "b1", submissions([1], 3) + submissions([2], 4))
    load(lake, "activity_logs", "b1", activity([1], 3) + activity([2], 4))
    for entity, key, prefix in (("submissions", "submission_id", "S"), ("activity_logs", "activity_id", "X")):
        jobs.remove_rows(lake, entity, lake.spark.createDataFrame([(f"{prefix}1",)], f"{key} string"))
        assert [r[0] for r in jobs.curated(lake, entity).select(key).collect()] == [f"{prefix}2"]


def test_changes_of_dimensions_and_late_keys(lake):
    load(lake, "submissions", "b1", submissions([1], 3))
    load(lake, "students", "b1", [{"student_id": "U1", "enrollment_status": "Active"}, {"student_id": "U2"}])
    assert jobs.transform_students(lake, now=LATER) == 1
    assert sorted(r.change for r in jobs.change_log(lake, "students").read(after=1).collect()) == ["after", "before"]
    assert jobs.backfill_table(lake, "submissions") == 1
    after = {r.change: r.student_key for r in jobs.change_log(lake, "submissions").read(after=1).collect()}
    assert after["before"] is None and after["after"] is not None
    assert jobs.backfill_table(lake, "submissions") == 0


@pytest.mark.parametrize("entity, rows, lost", [
    ("submissions", submissions, "replace_partitions"), ("activity_logs", activity, "write_text"), ("students", None, "replace"),
])
def test_a_crash_leaves_log_and_table_alike(lake, monkeypatch, entity, rows, lost):
    rows = rows or (lambda ids, month: [{"student_id": f"U{i}", "advisor_id": f"{month}"} for i in ids])
    key = ENTITIES[entity].key
    load(lake, entity, "b1", rows([1, 2], 3))
    real = getattr(lake, lost)

    def fails(name, *args):
        if name.startswith("curated/") or "/published/" in name:
            raise RuntimeError("lost")
        return real(name, *args)

    monkeypatch.setattr(lake, lost, fails)
    try:
        load(lake, entity, "b2", rows([2, 3], 4), now=LATER)
    except RuntimeError:
        pass
    monkeypatch.setattr(lake, lost, real)
    load(lake, entity, "b2", rows([2, 3], 4), now=LATER)
    load(lake, entity, "b3", rows([5], 4), now=LATER)
    held = jobs.curated(lake, entity)
    assert sorted(r[0][1:] for r in held.select(key).collect()) == ["1", "2", "3", "5"]
    columns = [c for c in held.columns if c not in ("created_at", "updated_at")]
    net = jobs.change_log(lake, entity).net().groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")
    assert sorted(map(str, net.select(*columns).collect())) == sorted(map(str, held.select(*columns).collect()))


def test_a_consumer_moves_on_only_when_it_is_done(lake):
    load(lake, "students", "b1", [{"student_id": "U1"}])
    logs, seen = {"dim_students": jobs.change_log(lake, "students")}, []

    def fails(spans):
        raise RuntimeError("lost")

    reader = Consumer(lake, "report")
    with pytest.raises(RuntimeError):
        reader.run(logs, fails)
    load(lake, "students", "b2", [{"student_id": "U2"}])
    assert Consumer(lake, "report").run(logs, seen.append) and not reader.run(logs, seen.append)
    load(lake, "students", "b3", [{"student_id": "U2"}])
    reader.run(logs, seen.append)
    assert seen == [{"dim_students": (0, 2)}, {"dim_students": (2, 3)}]
    assert Consumer(lake, "other").position("dim_students") == 0
