import json
from datetime import datetime
from decimal import Decimal

import pytest

from lectern.operators import extract, search, upsert
from lectern.plans import jobs
from lectern.schemas import ENTITIES, RAW_SCHEMA
from lectern.sources import landing
from lectern.sources.segments import Segments
from lectern.sources.store import Lake
from lectern.streaming import streams

NOW = datetime(2024, 2, 1)


def drop_file(folder, name, *payloads, at="2024-01-01T00:00:00"):
    rows = [{"raw_id": f"{name}-{i}", "payload": json.dumps(p), "source_system": "CANVAS_LMS", "file_name": name,
             "ingested_at": at, "processing_status": "PENDING"} for i, p in enumerate(payloads)]
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def test_later_arrival_wins_and_replays_are_safe(spark, tmp_path, folder):
    drop_file(folder, "a", {"student_id": "U1", "gpa": 2.0}, {"student_id": "U2", "gpa": 3.0})
    lake = Lake(spark, str(tmp_path / "lake"))

    def run(checkpoint):
        raw = streams.read_landing(spark, str(folder))
        streams.stream_upsert(raw, "students", lake, checkpoint=str(tmp_path / checkpoint), now=NOW).awaitTermination()
        return {r.student_id: r.gpa for r in jobs.curated(lake, "students").collect()}

    run("c1")
    drop_file(folder, "b", {"student_id": "U2", "gpa": 3.5}, {"student_id": "U3", "gpa": 1.0}, at="2024-01-02T00:00:00")
    streamed = run("c1")
    raw = spark.read.schema(RAW_SCHEMA).json(str(folder))
    batch = upsert.latest_per_key(extract.extract(raw, "students", keep=upsert.BATCH_ORDER), ["student_id"])
    assert streamed == {r.student_id: r.gpa for r in batch.collect()} == {"U1": Decimal("2.00"), "U2": Decimal("3.50"), "U3": Decimal("1.00")}
    assert run("c2") == streamed
    # What arrives later counts, also if it was ingested earlier.
    drop_file(folder, "c", {"student_id": "U2", "gpa": 1.5}, at="2023-01-01T00:00:00")
    assert run("c1")["U2"] == Decimal("1.50")


def test_insert_once_keeps_late_rows(spark, tmp_path, folder):
    log = lambda i, at: {"activity_id": f"X{i}", "activity_timestamp": at}
    drop_file(folder, "a", log(1, "2024-06-01T00:00:00Z"), log(1, "2024-06-01T00:00:00Z"))
    drop_file(folder, "b", log(1, "2024-06-02T00:00:00Z"), log(2, "2020-01-01T00:00:00Z"))
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = ", ".join(f"{c} {t}" for c, t in ENTITIES["activity_logs"].fields.items())
    rows = extract.extract(streams.read_landing(spark, str(folder), files_per_batch=1), "activity_logs")
    streams.stream_insert_once(rows, lake, "act", schema, key="activity_id", checkpoint=str(tmp_path / "c")).awaitTermination()
    assert sorted(r.activity_id for r in lake.read("act", schema).collect()) == ["X1", "X2"]


def test_rejected_rows_of_a_stream_are_noted(spark, tmp_path, folder):
    drop_file(folder, "a", {"student_id": "U1", "gpa": 2.0})
    torn = {"raw_id": "a-9", "payload": '{"student_id":"U2"', "source_system": "CANVAS_LMS", "file_name": "a",
            "ingested_at": "2024-01-01T00:00:00", "processing_status": "PENDING"}
    with open(folder / "a.json", "a") as f:
        f.write("\n" + json.dumps(torn))
    lake = Lake(spark, str(tmp_path / "lake"))
    for checkpoint in ("c1", "c1"):
        raw = streams.read_landing(spark, str(folder))
        streams.stream_upsert(raw, "students", lake, checkpoint=str(tmp_path / checkpoint), now=NOW).awaitTermination()
    assert jobs.curated(lake, "students").count() == 1
    assert [(r.raw_id, r.reason) for r in lake.read("audit/rejected", landing.REJECTED_SCHEMA).collect()] == [("a-9", "MALFORMED_JSON")]
    assert lake._children(f"{lake.root}/staging/students") == []


def test_spend_of_late_hours_is_revised(spark, tmp_path):
    schema, path = "warehouse_name string, start_time timestamp, credits_used decimal(18,6)", str(tmp_path / "in")
    lake, sent = Lake(spark, str(tmp_path / "lake")), []
    at = lambda day, hour, minute=0: datetime(2024, 1, day, hour, minute)

    def run():
        stream = spark.readStream.schema(schema).parquet(path)
        streams.stream_spend(stream, lake, "spend", checkpoint=str(tmp_path / "c")).awaitTermination()

    def send(*rows):
        sent.extend(rows)
        spark.createDataFrame([(w, t, Decimal(c)) for w, t, c in rows], schema).coalesce(1).write.mode("append").parquet(path)
        run()

    def hours():
        return {(r.warehouse_name, r.usage_hour): (r.estimated_cost_usd, r.version, r.spike, r.state) for r in streams.spend_hours(lake, "spend").collect()}

    send(("DEMO_A", at(1, 9, 5), "1"), ("DEMO_A", at(1, 12, 30), "2"), ("OTHER", at(1, 9), "9"), ("DEMO_A", None, "5"))
    assert hours() == {("DEMO_A", at(1, 9)): (3, 1, False, "CLOSED"), ("DEMO_A", at(1, 12)): (6, 1, False, "OPEN")}
    # The open hour grows, a closed one is corrected, and an older day comes last.
    send(("DEMO_A", at(1, 12, 59), "2"), ("DEMO_A", at(1, 9, 59), "3"))
    assert hours() == {("DEMO_A", at(1, 9)): (12, 2, True, "CLOSED"), ("DEMO_A", at(1, 12)): (12, 2, True, "OPEN")}
    # A micro-batch that runs again, since its commit was lost, adds nothing.
    for found in (tmp_path / "c" / "commits").iterdir():
        if found.name.strip(".").split(".")[0] == "1":
            found.unlink()
    run()
    assert hours()["DEMO_A", at(1, 9)] == (12, 2, True, "CLOSED")
    for i in range(6):
        send(("DEMO_B", at(1 + i % 3, 10, i), "-0.5"), ("DEMO_A", at(1, 12, i), "1"))
    assert len(Segments(lake, "spend").live()) <= 6
    streams.end_spend(lake, "spend")
    got = hours()
    assert {s[3] for s in got.values()} == {"CLOSED"}
    want = {}
    for w, t, c in sent:
        if w.startswith("DEMO_") and t:
            key = (w, t.replace(minute=0))
            want[key] = want.get(key, 0) + 3 * Decimal(c)
    assert {k: v[0] for k, v in got.items()} == want
    # What comes after the end opens the last hours again.
    send(("DEMO_A", at(3, 10, 30), "1"),)
    assert hours()["DEMO_A", at(3, 10)][3] == "OPEN"


def test_spend_of_no_input(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = "warehouse_name string, start_time timestamp, credits_used decimal(18,6)"
    spark.createDataFrame([("X", datetime(2024, 1, 1), Decimal(1))], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    streams.stream_spend(stream, lake, "spend", checkpoint=str(tmp_path / "c")).awaitTermination()
    assert streams.spend_hours(lake, "spend").collect() == []


def test_index_keeps_the_newest_word_on_a_document(spark, tmp_path):
    corpus = search.Corpus("id", "title", (), "1 hour")
    schema, path = "id string, title string, search_text string, version int", str(tmp_path / "in")
    lake = Lake(spark, str(tmp_path / "lake"))

    def send(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        streams.stream_index(stream, corpus, lake, "docs", checkpoint=str(tmp_path / "c"), order=["version"]).awaitTermination()

    def found(word):
        asked = spark.createDataFrame([(word, word)], "query_id string, query string")
        rows = search.search(streams.stored_index(lake, "docs", corpus), asked).collect()
        assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1))
        return sorted(r.doc_id for r in rows)

    send(("a", "A", "red fox", 1), ("b", "B", "red bird", 1), ("c", "C", "red sea", 1))
    send(("a", "A", "green fox", 3), ("a", "A", "blue fox", 2), ("c", "C", None, 2))
    assert found("red") == ["b"] and found("green") == ["a"] and found("blue") == [] and found("fox") == ["a"]
    assert streams.stored_index(lake, "docs", corpus).docs.count() == 2


def test_index_of_many_refreshes_stays_in_few_segments(spark, tmp_path):
    corpus = search.Corpus("id", "title", ("kind",), "1 hour")
    schema, path = "id string, title string, search_text string, kind string, version int", str(tmp_path / "in")
    lake, now = Lake(spark, str(tmp_path / "lake")), {}
    words = ["red", "green", "blue", "fox", "bird", "sea"]

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        streams.stream_index(stream, corpus, lake, "docs", checkpoint=str(tmp_path / "c"), order=["version"]).awaitTermination()

    for i in range(21):
        rows = [(f"d{(i * 5 + j) % 23}", f"t{i}", None if (i + j) % 7 == 0 else f"{words[i % 6]} {words[j % 6]} n{i}", "even" if j % 2 else "odd", i)
                for j in range(4)]
        now.update((r[0], r) for r in rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        if i == 10:
            run()
    run()
    live = Segments(lake, "docs").live()
    assert len(live) <= 6 and max(s.level for s in live) == 2
    index, plain = streams.stored_index(lake, "docs", corpus), search.build_index(spark.createDataFrame(list(now.values()), schema), corpus)
    asked = spark.createDataFrame([(w, w) for w in [*words, "n3", "n20"]], "query_id string, query string")
    for where in (None, {"kind": ["odd"]}):
        got, want = (sorted(map(tuple, search.search(x, asked, where=where).collect())) for x in (index, plain))
        assert got == want and got
    # The last micro-batch runs again and adds nothing.
    last = max((f for f in (tmp_path / "c" / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    for f in (last, last.with_name(f".{last.name}.crc")):
        f.unlink(missing_ok=True)
    run()
    assert Segments(lake, "docs").live() == live


def test_search_refresh_lands_in_parallel(spark, sf_dir, monkeypatch):
    """Each of the two landings is one micro-batch, of as many files as its source has partitions."""
    from pyspark.sql import DataFrameWriter

    from lectern.plans import catalog

    batches, partitions = [], []
    index, write = search.build_index, DataFrameWriter.parquet
    monkeypatch.setattr(search, "build_index", lambda batch, *a: batches.append(batch.count()) or index(batch, *a))

    def parquet(self, path, *a, **b):
        if "landing" in path:
            partitions.append(self._df.rdd.getNumPartitions())
        return write(self, path, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        catalog.queries()["stream_search_refresh"](spark, sf_dir).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(batches) == 2 and min(partitions) > 2
