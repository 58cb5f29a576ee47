from pyspark.sql import functions as F

from lectern.functions.hashing import dense_index
from lectern.operators import generate
from lectern.schemas import ENTITIES


def test_same_seed_same_rows_other_seed_other_rows(spark):
    a, b, c = (generate.generate_students(spark.range(200).repartition(n), seed=s) for n, s in ((1, 1), (5, 1), (1, 2)))
    assert sorted(a.collect()) == sorted(b.collect()) and sorted(a.collect()) != sorted(c.collect())


def test_dense_index_is_a_permutation(spark):
    df = spark.range(5000).selectExpr("concat('k', id) AS k")
    assert sorted(r.idx for r in dense_index(df, "k", buckets=16).collect()) == list(range(5000))


def test_enrollments_are_drawn_without_replacement(spark):
    s, c = generate.generate_students(spark.range(300)), generate.generate_courses(spark.range(37))
    e = generate.generate_enrollments(s, c, 5)
    assert e.count() == 1500 and e.select("student_id", "course_id").distinct().count() == 1500
    assert e.select("enrollment_id").distinct().count() == 1500 and e.select("course_id").distinct().count() == 37


def test_small_catalogue_gives_every_course(spark):
    s, c = generate.generate_students(spark.range(20)), generate.generate_courses(spark.range(3))
    e = generate.generate_enrollments(s, c, 5)
    assert e.count() == 60 and e.select("student_id", "course_id").distinct().count() == 60
    assert generate.generate_enrollments(s, c.limit(0), 5).count() == 0


def test_value_ranges(spark):
    d = generate.generate_all(spark, students=200, courses=20, per_enrollment=3)
    assert d["students"].where("gpa < 2 OR gpa > 4 OR year(expected_graduation) <> year(enrollment_date) + 4").count() == 0
    assert set(r.major for r in d["students"].select("major").distinct().collect()) <= set(generate.MAJORS)
    assert d["courses"].where("NOT course_code RLIKE '^[A-Z]{3}-[1-4][0-9]{3}$'").count() == 0
    assert d["enrollments"].where("final_score < 50 OR final_score > 100").count() == 0
    assert d["enrollments"].where("final_grade IS NULL").count() > 0
    a = d["assignments"]
    assert a.where("unlock_date <> date_trunc('day', due_date) - INTERVAL '7' DAY OR lock_date <> due_date + INTERVAL '3' DAY").count() == 0
    assert a.where("assignment_type = 'Exam' AND (points_possible < 100 OR points_possible > 200)").count() == 0
    x = d["submissions"]
    share = x.count() / d["enrollments"].join(a, "course_id").count()
    assert 0.88 < share < 0.92 and x.where("percentage < 0 OR percentage > 100 OR score > points_possible").count() == 0
    assert 75 < x.agg(F.avg("percentage")).first()[0] < 80 and x.where("graded_at <= submitted_at").count() == 0
    v = d["activity_logs"]
    assert v.count() == 3000 and v.where("duration_seconds < 10 OR duration_seconds > 3600 OR hour(activity_timestamp) < 6").count() == 0


def test_payloads_round_trip(spark):
    from lectern.operators import extract
    rows = generate.generate_assignments(generate.generate_courses(spark.range(3)), 4)
    raw = generate.as_payload(rows, "assignments").withColumn("processing_status", F.lit("PENDING"))
    assert sorted(extract.extract(raw, "assignments").collect()) == sorted(rows.select(*ENTITIES["assignments"].fields).collect())


def test_long_numbers_are_not_cut(spark):
    rows = generate.generate_students(spark.createDataFrame([(10**14 + 1,), (7,)], "id long")).collect()
    assert {r.student_id for r in rows} == {"U100000000000001", "U000000000007"}
    code = generate.course_code(F.lit("BIO"), F.lit(123456))
    assert spark.range(1).select(code.alias("c")).first().c == "BIO-123456"
