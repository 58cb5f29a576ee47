from datetime import date, datetime
from decimal import Decimal

from lectern.operators import extract
from lectern.schemas import RAW_SCHEMA

NOW = datetime(2024, 2, 1)


def raw(spark, *payloads, status="PENDING"):
    rows = [(f"r{i}", p, "CANVAS_LMS", "f.json", NOW, status) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_types_and_rounding(spark):
    row = extract.extract(raw(spark, '{"student_id":"U1","canvas_user_id":12.7,"gpa":3.456,"enrollment_date":"2024-08-19"}'),
                          "students").first()
    assert (row.canvas_user_id, row.gpa, row.enrollment_date) == (13, Decimal("3.46"), date(2024, 8, 19))
    assert row.major is None


def test_wrong_type_is_null_in_that_column_only(spark):
    row = extract.extract(raw(spark, '{"student_id":"U1","gpa":"high","enrollment_date":"soon","major":"Physics"}'),
                          "students").first()
    assert (row.gpa, row.enrollment_date, row.major) == (None, None, "Physics")


def test_zone_suffix_and_flags(spark):
    row = extract.extract(raw(spark, '{"submission_id":"S1","submitted_at":"2024-10-15T23:45:00Z","late_flag":true,"score":null}'),
                          "submissions").first()
    assert (row.submitted_at, row.late_flag, row.score) == (datetime(2024, 10, 15, 23, 45), True, None)


def test_every_row_is_extracted_or_rejected(spark):
    bad = ['{"student_id":"U2","major', "", "[1,2]", "7", '{"major":"x"}', '{"student_id":null}', None]
    df = raw(spark, '{"student_id":"U1"}', *bad)
    assert extract.extract(df, "students").count() == 1
    reasons = {r.raw_id: r.reason for r in extract.rejected(df, "students").collect()}
    assert len(reasons) == len(bad)
    assert reasons["r1"] == "MALFORMED_JSON" and reasons["r5"] == "MISSING_KEY" and reasons["r6"] == "MISSING_KEY"


def test_status_filter(spark):
    done = raw(spark, '{"student_id":"U1"}', status="PROCESSED")
    assert extract.extract(done, "students").count() == 0
    assert extract.extract(done, "students", status=None).count() == 1


def test_land_raw_envelope(spark):
    landed = extract.land_raw(spark.createDataFrame([("{}",), ("x",)], "payload string"), now=NOW, file_name="a.json")
    rows = landed.collect()
    assert {r.processing_status for r in rows} == {"PENDING"} and len({r.raw_id for r in rows}) == 2
    assert landed.columns == ["raw_id", "payload", "source_system", "file_name", "ingested_at", "processing_status"]


def test_json_is_parsed_once_per_row(spark):
    plan = extract.extract(raw(spark, "{}"), "submissions")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1 and "from_json" not in plan
