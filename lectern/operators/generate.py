"""Synthetic learning data at any size, as payload columns of the six entities.

Rows come from ids by hashing, so every generator is one distributed pass, repeatable by seed, and
a task run again yields the same rows. Ids are unique by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.hashing import between, choice, dense_index, normal, uniform
from lectern.schemas import ENTITIES

# The lists, weights and ranges of the generated data.
MAJORS = [
    "Computer Science", "Software Engineering", "Data Science",
    "Information Systems", "Cybersecurity", "Computer Engineering",
    "Biology", "Chemistry", "Physics", "Mathematics",
    "Business Administration", "Marketing", "Finance", "Accounting",
    "Psychology", "Nursing", "Education", "Communications",
    "Environmental Science", "Civil Engineering", "Mechanical Engineering",
]
CLASSIFICATIONS = ["Freshman", "Sophomore", "Junior", "Senior"]
STUDENT_STATUSES = ["Active", "Active", "Active", "Active", "Inactive", "Probation"]
DEPARTMENTS = {
    "COP": "Computer Science", "CIS": "Information Systems", "CAP": "Applied Computing", "CDA": "Computer Design",
    "CNT": "Networking", "CEN": "Software Engineering", "MAT": "Mathematics", "STA": "Statistics", "PHY": "Physics",
    "CHM": "Chemistry", "BIO": "Biology", "ACC": "Accounting", "FIN": "Finance", "MAN": "Management",
    "MAR": "Marketing",
}
COURSE_NAMES = {
    "COP": ["Introduction to Programming", "Data Structures", "Algorithms", "Database Systems", "Operating Systems",
            "Computer Networks", "Software Engineering", "Web Development"],
    "CIS": ["Information Systems Fundamentals", "Business Intelligence", "Enterprise Systems",
            "IT Project Management", "Systems Analysis and Design"],
    "MAT": ["Calculus I", "Calculus II", "Linear Algebra", "Discrete Mathematics", "Differential Equations",
            "Numerical Methods"],
    "STA": ["Statistics I", "Statistics II", "Probability Theory", "Data Analysis"],
    "ACC": ["Financial Accounting", "Managerial Accounting", "Auditing", "Tax Accounting"],
    "FIN": ["Corporate Finance", "Investments", "Financial Markets", "Risk Management"],
}
CREDIT_HOURS = [1, 2, 3, 3, 3, 4]
DELIVERY_MODES = ["In-Person", "Online", "Hybrid"]
TERMS = ["Fall 2024", "Spring 2025"]
MAX_ENROLLMENTS = [25, 30, 35, 40, 50, 100, 200]
ENROLLMENT_STATES = ["active", "active", "active", "active", "completed", "dropped"]
FINAL_GRADES = ["A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D", "F", None]
ASSIGNMENT_TYPES = {
    "Quiz": (20, 50), "Homework": (10, 25), "Exam": (100, 200), "Project": (50, 150), "Discussion": (10, 20),
    "Lab": (25, 50),
}
TOPICS = ["Chapter", "Module", "Unit", "Week"]
SUBMISSION_GRADES = ["A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "F"]
ATTEMPTS = [1, 1, 1, 1, 2, 2, 3]
ACTIVITY_TYPES = ["PageView", "Assignment", "Quiz", "Discussion", "VideoWatch", "FileDownload"]
DEVICES = ["Desktop", "Mobile", "Tablet"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]

FIRST_NAMES = ["Ada", "Ben", "Chloe", "Dario", "Esra", "Finn", "Grace", "Hugo", "Ines", "Jonas", "Kira", "Liam",
               "Mona", "Nils", "Olga", "Pablo", "Rosa", "Sven", "Tara", "Yusuf"]
LAST_NAMES = ["Adler", "Brandt", "Costa", "Diaz", "Evans", "Fischer", "Gupta", "Hansen", "Ito", "Jensen", "Kaya",
              "Lopez", "Meyer", "Novak", "Okoye", "Patel", "Quinn", "Rossi", "Silva", "Tanaka"]


def padded(n: Column, digits: int) -> Column:
    """A number with at least that many digits."""
    text = n.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def student_code(n: Column, digits: int = 12) -> Column:
    """``U`` and a zero-padded number."""
    return F.concat(F.lit("U"), padded(n, digits))


def course_code(dept: Column, number: Column) -> Column:
    """``DEPT-1234``."""
    return F.concat(dept, F.lit("-"), padded(number, 4))


def _code(prefix: str, low: int, high: int, salt: str, seed: int, *ids) -> Column:
    return F.concat(F.lit(prefix), between(low, high, salt, seed, *ids).cast("string"))


def _payload(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in ENTITIES[entity].fields.items() if c in df.columns])


def generate_students(ids: DataFrame, *, seed: int = 42) -> DataFrame:
    """One student per row of ``ids`` (a unique integer column ``id``)."""
    klass = choice(CLASSIFICATIONS, "class", seed, "id")
    years = F.element_at(F.create_map(*[F.lit(v) for i, c in enumerate(CLASSIFICATIONS) for v in (c, 2024 - i)]),
                         F.col("classification"))
    df = ids.select("id", student_code(F.col("id")).alias("student_id"), klass.alias("classification")).withColumn(
        "year", years
    )
    return _payload(df.withColumns({
        "canvas_user_id": between(100000, 999999, "user", seed, "id"),
        "first_name": choice(FIRST_NAMES, "first", seed, "id"),
        "last_name": choice(LAST_NAMES, "last", seed, "id"),
        "email": F.concat(F.lower("student_id"), F.lit("@demo-university.edu")),
        "major": choice(MAJORS, "major", seed, "id"),
        "enrollment_status": choice(STUDENT_STATUSES, "status", seed, "id"),
        "enrollment_date": F.make_date("year", F.lit(8), between(15, 25, "day", seed, "id").cast("int")),
        "expected_graduation": F.make_date(F.col("year") + 4, F.lit(5), F.lit(15)),
        "gpa": F.round(2 + 2 * uniform("gpa", seed, "id"), 2).cast("decimal(3,2)"),
        "advisor_id": _code("ADV", 1000, 9999, "advisor", seed, "id"),
    }), "students")


def generate_courses(ids: DataFrame, *, seed: int = 42) -> DataFrame:
    dept = choice(list(DEPARTMENTS), "dept", seed, "id")
    names = F.create_map(*[F.lit(v) for kv in DEPARTMENTS.items() for v in kv])
    df = ids.select(
        "id", dept.alias("dept"), between(1000, 4999, "number", seed, "id").alias("number"),
        choice(TERMS, "term", seed, "id").alias("term"),
    ).withColumn("department", F.element_at(names, F.col("dept")))
    title = F.concat("department", F.lit(" Topics "), F.col("number").cast("string"))
    for code, titles in COURSE_NAMES.items():
        title = F.when(F.col("dept") == code, choice(titles, "title", seed, "id")).otherwise(title)
    fall = F.col("term").startswith("Fall")
    day = lambda a, b: F.when(fall, F.to_date(F.lit(a))).otherwise(F.to_date(F.lit(b)))
    return _payload(df.withColumns({
        "course_id": F.concat(F.lit("CRS"), padded(F.col("id"), 12)),
        "canvas_course_id": between(10000, 99999, "canvas", seed, "id"),
        "course_code": course_code(F.col("dept"), F.col("number")),
        "course_name": title,
        "credit_hours": choice(CREDIT_HOURS, "credits", seed, "id"),
        "course_level": F.when(F.col("number") < 5000, "Undergraduate").otherwise("Graduate"),
        "delivery_mode": choice(DELIVERY_MODES, "mode", seed, "id"),
        "academic_year": F.lit("2024-2025"),
        "instructor_id": _code("INS", 1000, 9999, "instructor", seed, "id"),
        "instructor_name": F.concat(choice(FIRST_NAMES, "ifirst", seed, "id"), F.lit(" "),
                                    choice(LAST_NAMES, "ilast", seed, "id")),
        "start_date": day("2024-08-19", "2025-01-08"),
        "end_date": day("2024-12-13", "2025-05-01"),
        "max_enrollment": choice(MAX_ENROLLMENTS, "seats", seed, "id"),
    }), "courses")


def generate_enrollments(students: DataFrame, courses: DataFrame, per_student: int = 5, *, seed: int = 42) -> DataFrame:
    """``per_student`` different courses for every student, or all courses where there are fewer.

    Each student starts at a random course number and takes equal random steps round the numbered
    catalogue. A step is at most the catalogue size over the number taken, so no course repeats and
    no student is ever paired with the whole catalogue.
    """
    catalogue = dense_index(courses.select("course_id", "term"), "course_id")
    n = courses.agg(F.count(F.lit(1))).scalar()
    take = F.least(F.lit(per_student).cast("bigint"), F.col("n"))
    taken = students.select("student_id").withColumn("n", n).where("n > 0").withColumn("take", take).select(
        "student_id", "n",
        F.pmod(F.xxhash64(F.lit("start"), F.lit(seed), "student_id"), F.col("n")).alias("start"),
        (1 + F.pmod(F.xxhash64(F.lit("step"), F.lit(seed), "student_id"), F.expr("n div take"))).alias("step"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("take") - 1)).alias("j"),
    ).select("student_id", "j", F.pmod(F.col("start") + F.col("j") * F.col("step"), F.col("n")).alias("idx"))
    ids = ("student_id", "course_id")
    return _payload(taken.join(catalogue, "idx").withColumns({
        "enrollment_id": F.concat(F.lit("ENR-"), "student_id", F.lit("-"), F.col("j").cast("string")),
        "enrollment_state": choice(ENROLLMENT_STATES, "state", seed, *ids),
        "enrollment_type": F.lit("StudentEnrollment"),
        "enrolled_at": F.when(F.col("term").contains("Fall"), F.lit("2024-08-15T10:00:00")).otherwise(
            F.lit("2025-01-06T10:00:00")).cast("timestamp_ntz"),
        "final_grade": choice(FINAL_GRADES, "grade", seed, *ids),
        "final_score": F.round(50 + 50 * uniform("score", seed, *ids), 1).cast("decimal(5,2)"),
    }), "enrollments")


def generate_assignments(courses: DataFrame, per_course: int = 15, *, seed: int = 42) -> DataFrame:
    ids = ("course_id", "i")
    df = courses.select("course_id", F.explode(F.sequence(F.lit(1), F.lit(per_course))).alias("i")).withColumn(
        "assignment_type", choice(list(ASSIGNMENT_TYPES), "type", seed, *ids)
    )
    points = F.lit(None).cast("bigint")
    for kind, (low, high) in ASSIGNMENT_TYPES.items():
        points = F.when(F.col("assignment_type") == kind, between(low, high, "points", seed, *ids)).otherwise(points)
    due = F.date_add(F.lit("2024-08-20").cast("date"), between(1, 100, "due", seed, *ids).cast("int"))
    night = F.expr("INTERVAL '23:59' HOUR TO MINUTE")
    df = df.withColumn("day", due)
    at = lambda days: F.date_add("day", days).cast("timestamp_ntz")
    return _payload(df.withColumns({
        "assignment_id": F.concat(F.lit("ASN-"), "course_id", F.lit("-"), F.col("i").cast("string")),
        "canvas_assignment_id": between(100000, 999999, "canvas", seed, *ids),
        "assignment_name": F.concat(
            "assignment_type", F.lit(" "), F.col("i").cast("string"), F.lit(": "), choice(TOPICS, "topic", seed, *ids),
            F.lit(" "), between(1, 15, "topic_no", seed, *ids).cast("string")),
        "points_possible": points,
        "due_date": at(0) + night,
        "unlock_date": at(-7),
        "lock_date": at(3) + night,
        "submission_types": F.when(F.col("assignment_type") == "Quiz", "online_quiz").otherwise(
            "online_upload,online_text_entry"),
        "is_group_assignment": (F.col("assignment_type") == "Project") & (uniform("group", seed, *ids) > 0.5),
        "weight": F.round(5 + 20 * uniform("weight", seed, *ids), 1).cast("decimal(5,2)"),
    }), "assignments")


def generate_submissions(enrollments: DataFrame, assignments: DataFrame, *, keep: float = 0.9, seed: int = 42) -> DataFrame:
    """A submission for about ``keep`` of all student and assignment pairs."""
    pairs = enrollments.select("student_id", "course_id").distinct().join(
        assignments.select("assignment_id", "course_id", "points_possible"), "course_id"
    )
    ids = ("student_id", "assignment_id")
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.78 + 0.15 * normal("mark", seed, *ids)))
    points = F.coalesce(F.col("points_possible"), F.lit(100)).cast("double")
    df = pairs.where(uniform("handed_in", seed, *ids) <= keep).withColumns({
        "share": share, "points": points,
        "hours": between(-48, 2, "hour", seed, *ids), "days": between(1, 7, "graded", seed, *ids),
    })
    rank = F.least(F.floor((1 - F.col("share")) * 10), F.lit(len(SUBMISSION_GRADES) - 1)).cast("int")
    grades = F.array(*[F.lit(g) for g in SUBMISSION_GRADES])
    submitted = F.expr("TIMESTAMP_NTZ'2024-10-15 23:45:00' + hours * INTERVAL '1' HOUR")
    return _payload(df.drop("points_possible").withColumns({
        "submission_id": F.concat(F.lit("SUB-"), "student_id", F.lit("-"), "assignment_id"),
        "submitted_at": submitted,
        "graded_at": submitted + F.expr("days * INTERVAL '1' DAY"),
        "score": F.round(F.col("share") * F.col("points"), 1),
        "grade": F.when(F.col("share") > 0.1, F.element_at(grades, rank + 1)).otherwise("F"),
        "points_possible": F.col("points"),
        "percentage": F.round(F.col("share") * 100, 1),
        "submission_type": choice(["online_upload", "online_text_entry"], "how", seed, *ids),
        "attempt_number": choice(ATTEMPTS, "attempt", seed, *ids),
        "late_flag": uniform("late", seed, *ids) < 0.1,
        "missing_flag": F.lit(False),
        "excused_flag": uniform("excused", seed, *ids) < 0.02,
        "grader_id": _code("GRD", 1000, 9999, "grader", seed, *ids),
    }), "submissions")


def generate_activity(enrollments: DataFrame, per_enrollment: int = 25, *, seed: int = 42) -> DataFrame:
    df = enrollments.select("enrollment_id", "student_id", "course_id")
    df = df.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(per_enrollment))))
    ids = ("enrollment_id", "i")
    minutes = (
        between(0, 100, "day", seed, *ids) * 1440 + between(6, 23, "hour", seed, *ids) * 60
        + between(0, 59, "minute", seed, *ids)
    )
    part = lambda low, high, salt: between(low, high, salt, seed, *ids).cast("string")
    kind = choice(ACTIVITY_TYPES, "type", seed, *ids)
    df = df.withColumns({"activity_type": kind, "minutes": minutes})
    return _payload(df.withColumns({
        "activity_id": F.concat(F.lit("ACT-"), "enrollment_id", F.lit("-"), F.col("i").cast("string")),
        "activity_timestamp": F.expr("TIMESTAMP_NTZ'2024-08-20 00:00:00' + minutes * INTERVAL '1' MINUTE"),
        "duration_seconds": between(10, 3600, "seconds", seed, *ids),
        "page_url": F.concat(F.lit("/courses/"), "course_id", F.lit("/"), F.lower("activity_type"), F.lit("/"),
                             part(1, 100, "page")),
        "device_type": choice(DEVICES, "device", seed, *ids),
        "browser": choice(BROWSERS, "browser", seed, *ids),
        "ip_address": F.concat_ws(".", part(10, 200, "a"), part(0, 255, "b"), part(0, 255, "c"), part(1, 254, "d")),
    }), "activity_logs")


def generate_all(spark: SparkSession, *, students: int = 100, courses: int = 20, per_student: int = 5,
                 per_course: int = 15, per_enrollment: int = 25, seed: int = 42) -> dict[str, DataFrame]:
    """Payload columns of all six entities."""
    s = generate_students(spark.range(students), seed=seed)
    c = generate_courses(spark.range(courses), seed=seed)
    e = generate_enrollments(s, c, per_student, seed=seed)
    a = generate_assignments(c, per_course, seed=seed)
    return {
        "students": s, "courses": c, "enrollments": e, "assignments": a,
        "submissions": generate_submissions(e, a, seed=seed),
        "activity_logs": generate_activity(e, per_enrollment, seed=seed),
    }


def as_payload(rows: DataFrame, entity: str) -> DataFrame:
    """The generated columns as one JSON ``payload`` column, NULL fields left out."""
    fields = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c) if t == "timestamp_ntz" else F.col(c)
        for c, t in ENTITIES[entity].fields.items() if c in rows.columns
    ]
    return rows.select(F.to_json(F.struct(*fields)).alias("payload"))
