import random
from collections import defaultdict
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest

from lectern.operators import aggregates

NOW = datetime(2024, 2, 1)


def frames(spark, seed, *, single=False):
    """A small random school with repeated enrollments, resubmissions, orphans and NULLs."""
    rnd = random.Random(seed)
    students = [f"s{i}" for i in range(5)]
    courses = {f"c{i}": f"T{i % 2}" for i in range(4)}
    tasks = [(f"a{c}{i}", c) for c in courses for i in range(1 if single else rnd.randint(0, 3))]
    enroll, subs, acts = [], [], []
    for s in [*students, "ghost"]:
        for c in [*courses, "c-unknown"]:
            for _ in range(1 if single else rnd.choice([0, 1, 1, 2])):
                score = None if rnd.random() < 0.2 else Decimal(rnd.randint(4000, 10000)) / 100
                enroll.append((f"e{len(enroll)}", s, c, rnd.choice(["active", "completed", "dropped"]),
                               rnd.choice(["A", "B+", "F", None]), score))
            for a, ac in tasks:
                for _ in range(0 if ac != c else rnd.choice([0, 1]) if single else rnd.choice([0, 1, 2])):
                    pct = None if rnd.random() < 0.2 else Decimal(rnd.randint(0, 10000)) / 100
                    subs.append((f"x{len(subs)}", s, a, pct, Decimal(rnd.randint(0, 900)) / 10, Decimal(90),
                                 rnd.random() < 0.4, rnd.random() < 0.3))
            for _ in range(rnd.choice([0, 1]) if single else rnd.choice([0, 0, 1, 3])):
                acts.append((f"v{len(acts)}", s, c, datetime(2024, 1, rnd.randint(1, 28)), rnd.randint(10, 3600)))
    mk = spark.createDataFrame
    return dict(
        students=mk([(s,) for s in students], "student_id string"),
        enrollments=mk(enroll, "enrollment_id string, student_id string, course_id string, enrollment_state string, final_grade string, final_score decimal(5,2)"),
        courses=mk(list(courses.items()), "course_id string, term string"),
        assignments=mk(tasks or [("none", "nowhere")], "assignment_id string, course_id string"),
        submissions=mk(subs, "submission_id string, student_id string, assignment_id string, percentage decimal(5,2), score decimal(10,2), points_possible decimal(10,2), late_flag boolean, missing_flag boolean"),
        activity=mk(acts, "activity_id string, student_id string, course_id string, activity_timestamp timestamp_ntz, duration_seconds bigint"),
    )


def half_up(x, places="0.01"):
    return Decimal(x).quantize(Decimal(places), ROUND_HALF_UP)


def brute_force_fan_out(f):
    """The six-table join row by row."""
    data = {k: v.collect() for k, v in f.items()}
    groups = defaultdict(list)
    for e in data["enrollments"]:
        for c in data["courses"]:
            if c.course_id != e.course_id or e.student_id not in {s.student_id for s in data["students"]}:
                continue
            acts = [v for v in data["activity"] if (v.student_id, v.course_id) == (e.student_id, e.course_id)] or [None]
            for a in [a for a in data["assignments"] if a.course_id == c.course_id] or [None]:
                xs = [x for x in data["submissions"] if a and (x.student_id, x.assignment_id) == (e.student_id, a.assignment_id)] or [None]
                groups[e.student_id, e.course_id, c.term, e.final_grade] += [(a, x, v) for x in xs for v in acts]
    out = {}
    for key, rows in groups.items():
        pcts = [x.percentage for _, x, _ in rows if x and x.percentage is not None]
        xs = [x for _, x, _ in rows if x]
        secs = [v.duration_seconds for _, _, v in rows if v]
        out[key] = (
            len({a.assignment_id for a, _, _ in rows if a}), len({x.submission_id for x in xs}),
            half_up(sum(pcts) / len(pcts)) if pcts else None,
            sum(x.score for x in xs) if xs else None, sum(x.points_possible for x in xs) if xs else None,
            sum(x.late_flag for x in xs), sum(x.missing_flag for x in xs),
            int(half_up(Decimal(sum(secs)) / 60, "1")) if secs else 0,
        )
    return out


def result(df):
    return {(r.student_id, r.course_id, r.term, r.current_grade): (
        r.total_assignments, r.completed_assignments, r.avg_score, r.total_points_earned, r.total_points_possible,
        r.late_submissions, r.missing_submissions, r.total_activity_minutes) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_compat_equals_the_plain_join(spark, seed):
    f = frames(spark, seed)
    assert result(aggregates.student_course_performance(**f, now=NOW, compat=True)) == brute_force_fan_out(f)


def test_both_forms_agree_without_fan_out(spark):
    f = frames(spark, 11, single=True)
    plain = aggregates.student_course_performance(**f, now=NOW)
    assert result(plain) == result(aggregates.student_course_performance(**f, now=NOW, compat=True))


def test_course_analytics_against_brute_force(spark):
    f = frames(spark, 5)
    rows = f["enrollments"].collect()
    minutes = {(r.student_id, r.course_id): r.total_minutes for r in aggregates.engagement_minutes(f["activity"]).collect()}
    got = {r.course_id: r for r in aggregates.course_analytics(f["courses"], f["enrollments"], f["activity"], now=NOW).collect()}
    known = {r.course_id for r in f["courses"].collect()}
    assert set(got) == {r.course_id for r in rows} & known
    for c, r in got.items():
        mine = [e for e in rows if e.course_id == c]
        scores = sorted(e.final_score for e in mine if e.final_score is not None)
        mid = (scores[(len(scores) - 1) // 2] + scores[len(scores) // 2]) / 2
        spent = [minutes[e.student_id, c] for e in mine if (e.student_id, c) in minutes]
        assert r.total_enrolled == len({e.student_id for e in mine})
        assert r.active_students == len({e.student_id for e in mine if e.enrollment_state == "active"})
        assert r.avg_class_score == half_up(sum(scores) / len(scores)) and r.median_class_score == half_up(mid)
        assert r.completion_rate == half_up(Decimal(100 * sum(e.enrollment_state == "completed" for e in mine)) / len(mine))
        assert r.avg_engagement_minutes == (int(half_up(Decimal(sum(spent)) / len(spent), "1")) if spent else None)
        assert r.grade_distribution.A == sum(e.final_grade == "A" for e in mine)
        assert r.at_risk_students == sum(s < 60 for s in scores)


def test_student_risk_limits(spark):
    schema = "student_id string, avg_score decimal(5,2), late_submissions bigint, missing_submissions bigint, total_activity_minutes bigint"
    rows = [("ok", Decimal("70"), 5, 3, 1), ("low", Decimal("69.99"), 0, 0, 1), ("late", Decimal("99"), 3, 0, 1),
            ("late", Decimal("99"), 3, 0, 1), ("missing", None, 0, 4, 1), ("unscored", None, 0, 0, 1)]
    risk = aggregates.student_risk(spark.createDataFrame(rows, schema))
    assert {r.student_id for r in risk.collect()} == {"low", "late", "missing"}
