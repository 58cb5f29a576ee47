"""DuckDB SQL with the same answers as the registered queries.

The inputs come from the shared mapping; everything computed from them is written here on its own,
in SQL. Rounded ratios use integer arithmetic, so both engines round the same exact value half up.
"""

from __future__ import annotations

from lectern.plans.catalog import AGAIN, CHANGES, DEFAULT_NAMES, LATER, RAW_STATUS, RESENT, STORED
from lectern.schemas import ENTITIES
from lectern.sources import testbed as tbd


def _cols(mapping: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in mapping.items())


NOW_SQL, LATER_SQL = f"TIMESTAMP '{tbd.NOW}'", f"TIMESTAMP '{LATER}'"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "students": (f"SELECT {_cols(tbd.STUDENT)} FROM customer", ()),
    "courses": (f"SELECT {_cols(tbd.COURSE)} FROM part", ()),
    "assignment_base": (
        f"SELECT {_cols(tbd.ASSIGNMENT_BASE)} FROM (SELECT *, unnest(range(0, {tbd.ASSIGNMENTS_PER_COURSE})) AS i FROM part)", ()),
    "assignments": (f"SELECT {_cols(tbd.ASSIGNMENT)} FROM assignment_base", ("assignment_base",)),
    "enrollment_base": (
        f"SELECT o_custkey, l_partkey, {_cols(tbd.ENROLLMENT_BASE)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "GROUP BY o_custkey, l_partkey", ()),
    "enrollments": (f"SELECT {_cols(tbd.ENROLLMENT)} FROM enrollment_base", ("enrollment_base",)),
    "submissions": (
        f"SELECT {_cols(tbd.SUBMISSION)} FROM (SELECT e.*, a.* EXCLUDE (course_id) FROM enrollments e JOIN assignments a "
        f"ON e.course_id = a.course_id WHERE {tbd.SUBMISSION_MATCH})", ("enrollments", "assignments")),
    "activity_logs": (
        f"SELECT {_cols(tbd.ACTIVITY)} FROM events LEFT JOIN orders ON {tbd.EVENT_ORDER} = o_orderkey LEFT JOIN "
        "(SELECT l_orderkey, min(l_partkey) AS first_part FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey", ()),
    "rules": (
        "SELECT * FROM (VALUES " + ", ".join(str(r) for r in tbd.RULES)
        + ") AS r(resource_type, resource_name, cost_center, department, project)", ()),
    "runs": (f"SELECT {_cols(tbd.RUN)} FROM orders", ()),
    "engagement": (
        "SELECT student_id, course_id, (sum(duration_seconds) + 30) // 60 AS total_minutes FROM activity_logs "
        "GROUP BY student_id, course_id", ("activity_logs",)),
}
for _name, (_source, _where, _columns, _group) in tbd.METERING.items():
    CTES[_name] = (
        f"SELECT {_cols(_columns)} FROM {_source}" + (f" WHERE {_where}" if _where else "")
        + (f" GROUP BY {_group}" if _group else ""), ())


def with_ctes(select: str, *names: str) -> str:
    """``select`` with the named inputs and whatever they are built from."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in CTES[name][1]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        need(n)
    if not ordered:
        return select
    body = ", ".join(f"{n} AS MATERIALIZED ({CTES[n][0]})" for n in ordered)
    head = select.lstrip()
    return f"WITH {body}{', ' + head[5:] if head.startswith('WITH ') else ' ' + head}"


def half_up(num: str, den: str, scale: int) -> str:
    """``num / den`` of two integer expressions, rounded half up to ``scale`` digits, as DOUBLE."""
    n, d = f"CAST(({num}) AS HUGEINT) * {10 ** scale}", f"CAST(({den}) AS HUGEINT)"
    size = f"(2 * abs({n}) + abs({d})) // (2 * abs({d}))"
    sign = f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    return f"CASE WHEN ({den}) <> 0 THEN CAST({sign} * ({size}) AS DOUBLE) / {10 ** scale} END"


def cents(total: str, digits: int = 2) -> str:
    """A decimal sum as a whole number of its last digit."""
    return f"CAST({total} * {10 ** digits} AS HUGEINT)"


def mean(column: str, den: str | None = None) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / nullif({den or f'count({column})'}, 0)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ts(expr: str) -> str:
    return f"CAST({expr} AS TIMESTAMP)"


def out(column: str, spark_type: str, table: str = "") -> str:
    """One output column in its portable type."""
    name = f"{table}{column}"
    if spark_type.startswith("decimal"):
        return f"{dbl(name)} AS {column}"
    if spark_type in ("bigint", "int"):
        return f"{big(name)} AS {column}"
    if spark_type in ("date", "timestamp_ntz"):
        return f"{ts(name)} AS {column}"
    return f"{name} AS {column}"


def _typed(entity: str, columns=None, table: str = "") -> str:
    spec = ENTITIES[entity]
    return ", ".join(out(c, t, table) for c, t in spec.fields.items() if columns is None or c in columns)


# --- upserts ------------------------------------------------------------------------------------

def _resent(entity: str) -> str:
    """The feed's rows with their changed columns, brought to the curated types."""
    spec = ENTITIES[entity]
    cols = [f"CAST({CHANGES[entity].get(c, c)} AS {_duck(t)}) AS {c}" for c, t in spec.fields.items()]
    return f"SELECT {', '.join(cols)} FROM {entity} WHERE {RESENT[entity]}"


def _duck(t: str) -> str:
    return {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}.get(t, t.upper())


def _lookup(entity: str, table: str) -> tuple[str, str]:
    spec, select, joins = ENTITIES[entity], "", ""
    for i, (fk, (dim, natural)) in enumerate(spec.lookups.items()):
        select += f", d{i}.{ENTITIES[dim].surrogate} AS {fk}"
        joins += f" LEFT JOIN {dim} d{i} ON {table}.{natural} = d{i}.{natural}"
    return select, joins


# What the two load routes change of a stored row, and what the narrow one leaves open in a new one.
UPDATED = {
    ("students", "full"): ["canvas_user_id", "first_name", "last_name", "email", "major", "classification", "enrollment_status", "gpa",
                           "advisor_id"],
    ("courses", "full"): ["canvas_course_id", "course_code", "course_name", "department", "credit_hours", "course_level", "delivery_mode",
                          "term", "academic_year", "instructor_id", "instructor_name", "start_date", "end_date", "max_enrollment"],
    ("assignments", "full"): ["assignment_name", "points_possible", "due_date", "weight"],
    ("enrollments", "full"): ["enrollment_state", "completed_at", "final_grade", "final_score"],
    ("enrollments", "sql"): ["enrollment_state", "final_grade", "final_score"],
    ("submissions", "full"): ["graded_at", "score", "grade", "percentage", "late_flag", "missing_flag", "excused_flag", "grader_id"],
    ("submissions", "sql"): ["graded_at", "score", "grade", "percentage"],
}
SKIPPED = {("enrollments", "sql"): ["completed_at"]}


def _merge(entity: str, profile: str = "full", columns: list[str] | None = None) -> str:
    spec = ENTITIES[entity]
    updated, skipped = UPDATED.get((entity, profile), []), SKIPPED.get((entity, profile), [])
    dims = [d for d, _ in spec.lookups.values()]
    parts = {}
    for side, body in (("tgt", f"SELECT * FROM {entity} WHERE {STORED[entity]}"), ("src", _resent(entity))):
        extra, joins = _lookup(entity, "x")
        parts[side] = f"{side} AS (SELECT x.*{extra} FROM ({body}) x{joins})"
    matched, known = f"s.{spec.key} IS NOT NULL", f"t.{spec.key} IS NOT NULL"
    cols = []
    for c, t in spec.columns:
        if columns is not None and c not in columns:
            continue
        if c == spec.key:
            value = f"coalesce(t.{c}, s.{c})"
        elif c == spec.surrogate:
            value = f"t.{c}" if entity in ("students", "courses", "assignments") else "CAST(NULL AS BIGINT)"
        elif c == "created_at":
            value = f"CASE WHEN {known} THEN {NOW_SQL} ELSE {LATER_SQL} END"
        elif c == "updated_at":
            value = f"CASE WHEN {matched} THEN {LATER_SQL} ELSE {NOW_SQL} END"
        elif c == "is_current":
            value = f"CASE WHEN {known} THEN t.{c} ELSE true END"
        elif c in updated:
            value = f"CASE WHEN {matched} THEN s.{c} ELSE t.{c} END"
        elif c in skipped:
            value = f"t.{c}"
        else:
            value = f"CASE WHEN {known} THEN t.{c} ELSE s.{c} END"
        cols.append((c, t, value))
    inner = ", ".join(f"{v} AS {c}" for c, _, v in cols)
    outer = ", ".join(out(c, t) for c, t, _ in cols)
    return with_ctes(
        f"WITH {parts['tgt']}, {parts['src']} SELECT {outer} FROM (SELECT {inner} FROM tgt t FULL OUTER JOIN src s "
        f"ON t.{spec.key} = s.{spec.key})", entity, *dims)


def _changes(entity: str) -> str:
    """The difference of the stored part and what the feed makes of it, row by row."""
    spec, updated = ENTITIES[entity], UPDATED[entity, "full"]
    after = ", ".join(f"{'s' if c in updated else 'o'}.{c}" for c in spec.fields)
    return with_ctes(f"""WITH old AS (SELECT {_typed(entity)} FROM {entity} WHERE {STORED[entity]}),
      sent AS (SELECT {_typed(entity)} FROM ({_resent(entity)})),
      again AS (SELECT o.{spec.key} FROM old o JOIN sent s ON o.{spec.key} = s.{spec.key})
      SELECT 'before' AS change, * FROM old WHERE {spec.key} IN (SELECT * FROM again)
      UNION ALL SELECT 'after', {after} FROM old o JOIN sent s ON o.{spec.key} = s.{spec.key}
      UNION ALL SELECT 'insert', * FROM sent WHERE {spec.key} NOT IN (SELECT * FROM again)""", entity)


# --- rollups ------------------------------------------------------------------------------------

PERFORMANCE_INPUTS = ("students", "courses", "assignments", "enrollments", "submissions", "activity_logs")
# Submissions and activity are each summed per pair before the join.
PERFORMANCE = f"""
perf AS (
  WITH n AS (SELECT course_id, count(*) AS total FROM assignments GROUP BY course_id),
  g AS (SELECT DISTINCT e.student_id, e.course_id, c.term, e.final_grade, coalesce(n.total, 0) AS total
        FROM enrollments e JOIN students s ON e.student_id = s.student_id JOIN courses c ON e.course_id = c.course_id
        LEFT JOIN n ON n.course_id = c.course_id),
  m AS (SELECT x.student_id, a.course_id, count(DISTINCT submission_id) AS done, sum(percentage) AS pct,
        count(percentage) AS pct_n, sum(score) AS earned, sum(x.points_possible) AS possible,
        count(*) FILTER (late_flag) AS late, count(*) FILTER (missing_flag) AS missing
        FROM submissions x JOIN assignments a ON x.assignment_id = a.assignment_id GROUP BY x.student_id, a.course_id),
  v AS (SELECT student_id, course_id, sum(duration_seconds) AS secs, max(activity_timestamp) AS last_at
        FROM activity_logs GROUP BY student_id, course_id)
  SELECT g.student_id, g.course_id, g.term, g.total AS total_assignments, coalesce(m.done, 0) AS completed_assignments,
    {half_up(cents("m.pct"), "m.pct_n * 100", 2)} AS avg_score, m.earned AS total_points_earned,
    m.possible AS total_points_possible, coalesce(m.late, 0) AS late_submissions,
    coalesce(m.missing, 0) AS missing_submissions, coalesce((v.secs + 30) // 60, 0) AS total_activity_minutes,
    CAST(v.last_at AS DATE) AS last_activity_date, g.final_grade AS current_grade
  FROM g LEFT JOIN m ON m.student_id = g.student_id AND m.course_id = g.course_id
  LEFT JOIN v ON v.student_id = g.student_id AND v.course_id = g.course_id)"""
# The plain six-table join with all its repeated rows.
FAN_OUT = f"""
perf AS (
  SELECT s.student_id, c.course_id, c.term, count(DISTINCT a.assignment_id) AS total_assignments,
    count(DISTINCT x.submission_id) AS completed_assignments,
    {half_up(cents("sum(x.percentage)"), "count(x.percentage) * 100", 2)} AS avg_score,
    sum(x.score) AS total_points_earned, sum(x.points_possible) AS total_points_possible,
    sum(CASE WHEN x.late_flag THEN 1 ELSE 0 END) AS late_submissions,
    sum(CASE WHEN x.missing_flag THEN 1 ELSE 0 END) AS missing_submissions,
    coalesce((sum(v.duration_seconds) + 30) // 60, 0) AS total_activity_minutes,
    CAST(max(v.activity_timestamp) AS DATE) AS last_activity_date, e.final_grade AS current_grade
  FROM students s JOIN enrollments e ON s.student_id = e.student_id JOIN courses c ON e.course_id = c.course_id
  LEFT JOIN assignments a ON a.course_id = c.course_id
  LEFT JOIN submissions x ON x.student_id = s.student_id AND x.assignment_id = a.assignment_id
  LEFT JOIN activity_logs v ON v.student_id = s.student_id AND v.course_id = c.course_id
  GROUP BY s.student_id, c.course_id, c.term, e.final_grade)"""
PERFORMANCE_OUT = ", ".join([
    "student_id", "course_id", "term", f"{big('total_assignments')} AS total_assignments",
    f"{big('completed_assignments')} AS completed_assignments", "avg_score",
    f"{dbl('total_points_earned')} AS total_points_earned", f"{dbl('total_points_possible')} AS total_points_possible",
    f"{big('late_submissions')} AS late_submissions", f"{big('missing_submissions')} AS missing_submissions",
    f"{big('total_activity_minutes')} AS total_activity_minutes", f"{ts('last_activity_date')} AS last_activity_date",
    "current_grade",
])


def _on_performance(select: str, body: str = PERFORMANCE) -> str:
    return with_ctes(f"WITH {body.strip()} {select}", *PERFORMANCE_INPUTS)


BANDS = {
    "a": "('A', 'A-')", "b": "('B+', 'B', 'B-')", "c": "('C+', 'C', 'C-')", "d": "('D+', 'D', 'D-')", "f": "('F')",
}
BAND_COUNTS = ", ".join(f"count(*) FILTER (final_grade IN {g}) AS grade_{b}" for b, g in BANDS.items())
COURSE_ROLLUP = f"""
rollup_ AS (
  SELECT c.course_id, c.term, count(DISTINCT e.student_id) AS total_enrolled,
    count(DISTINCT CASE WHEN e.enrollment_state = 'active' THEN e.student_id END) AS active_students,
    {half_up(cents("sum(e.final_score)"), "count(e.final_score) * 100", 2)} AS avg_class_score,
    CAST(round(CAST(median(CAST(e.final_score AS DOUBLE)) AS DECIMAL(12,4)), 2) AS DOUBLE) AS median_class_score,
    {BAND_COUNTS},
    {half_up("count(*) FILTER (e.enrollment_state = 'completed') * 100", "count(*)", 2)} AS completion_rate,
    {big(half_up("sum(g.total_minutes)", "count(g.total_minutes)", 0))} AS avg_engagement_minutes,
    count(*) FILTER (e.final_score < 60) AS at_risk_students
  FROM courses c JOIN enrollments e ON c.course_id = e.course_id
  LEFT JOIN engagement g ON g.student_id = e.student_id AND g.course_id = c.course_id
  GROUP BY c.course_id, c.term)"""

# --- base views ---------------------------------------------------------------------------------

STANDING = ("CASE WHEN gpa >= 3.5 THEN 'Deans List' WHEN gpa >= 3.0 THEN 'Good Standing' "
            "WHEN gpa >= 2.0 THEN 'Satisfactory' ELSE 'Academic Probation' END")
CTES["v_students"] = (
    "SELECT student_id, canvas_user_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email, major, "
    "classification, enrollment_status, enrollment_date, expected_graduation, gpa, advisor_id, "
    f"{STANDING} AS academic_standing FROM students", ("students",))
CTES["v_enrollments"] = (
    "SELECT e.enrollment_id, e.student_id, e.course_id, e.enrolled_at AS enrollment_date, e.enrollment_state AS enrollment_status, "
    "e.final_grade, e.final_score, CASE WHEN final_score >= 90 THEN 4.0 WHEN final_score >= 80 THEN 3.0 WHEN final_score >= 70 THEN 2.0 "
    "WHEN final_score >= 60 THEN 1.0 WHEN final_score IS NOT NULL THEN 0.0 END AS grade_points, "
    "CASE WHEN final_score >= 90 THEN 'Excellent' WHEN final_score >= 80 THEN 'Good' WHEN final_score >= 70 THEN 'Satisfactory' "
    "WHEN final_score >= 60 THEN 'Poor' WHEN final_score IS NOT NULL THEN 'Failing' ELSE 'Not Graded' END AS grade_category, "
    "s.first_name AS student_first_name, s.last_name AS student_last_name, s.first_name || ' ' || s.last_name AS student_name, "
    "s.major AS student_major, s.classification AS student_classification, c.course_code, c.course_name, c.department, c.term, "
    "c.instructor_name, c.credit_hours FROM enrollments e LEFT JOIN students s ON e.student_id = s.student_id "
    "LEFT JOIN courses c ON e.course_id = c.course_id", ("students", "courses", "enrollments"))
CTES["v_submissions"] = (
    "SELECT x.submission_id, x.assignment_id, x.student_id, x.submitted_at AS submission_date, x.score, x.grade, x.late_flag, "
    "x.attempt_number, x.graded_at, x.grader_id, x.percentage, a.assignment_name, a.assignment_type, a.points_possible, a.due_date, "
    "a.course_id, CASE WHEN percentage >= 90 THEN 'Excellent' WHEN percentage >= 80 THEN 'Good' WHEN percentage >= 70 THEN "
    "'Satisfactory' WHEN percentage >= 60 THEN 'Below Average' ELSE 'Failing' END AS score_category, "
    "s.first_name AS student_first_name, s.last_name AS student_last_name, s.first_name || ' ' || s.last_name AS student_name, "
    "s.major AS student_major FROM submissions x LEFT JOIN assignments a ON x.assignment_id = a.assignment_id "
    "LEFT JOIN students s ON x.student_id = s.student_id", ("students", "submissions"))
V_PERFORMANCE = f"""
v_perf AS (
  SELECT p.student_id, p.course_id, p.term, p.total_assignments, p.completed_assignments, p.avg_score AS average_score,
    p.total_points_earned, p.total_points_possible, p.late_submissions, p.missing_submissions, p.total_activity_minutes,
    p.current_grade AS performance_grade, p.last_activity_date,
    coalesce({half_up("p.completed_assignments * 100", "p.total_assignments", 1)}, 0) AS completion_rate,
    s.first_name AS student_first_name, s.last_name AS student_last_name, s.first_name || ' ' || s.last_name AS student_name,
    s.major, s.classification, s.gpa AS overall_gpa, c.course_code, c.course_name, c.department, c.instructor_name
  FROM perf p LEFT JOIN students s ON p.student_id = s.student_id LEFT JOIN courses c ON p.course_id = c.course_id)"""


def _on_view(select: str) -> str:
    return _on_performance(select, f"{PERFORMANCE}, {V_PERFORMANCE}")


# --- search -------------------------------------------------------------------------------------

TEXTS = {
    "activity_logs": (
        "activity_type || ' activity on ' || coalesce(page_url, 'unknown page') || ' using ' || coalesce(device_type, 'unknown device') "
        "|| ' (' || coalesce(browser, 'unknown browser') || ') for ' || coalesce(CAST(duration_seconds AS VARCHAR), '0') || ' seconds'"),
    "courses": (
        "course_code || ' - ' || course_name || '. Department: ' || coalesce(department, 'Unknown') || '. Instructor: ' || "
        "coalesce(instructor_name, 'TBD') || '. Credits: ' || coalesce(CAST(credit_hours AS VARCHAR), 'N/A') || '. Level: ' || "
        "coalesce(course_level, 'Unknown') || '. Delivery: ' || coalesce(delivery_mode, 'Unknown') || '. Term: ' || coalesce(term, 'Unknown')"),
    "students": (
        "first_name || ' ' || last_name || '. Major: ' || coalesce(major, 'Undeclared') || '. Classification: ' || "
        "coalesce(classification, 'Unknown') || '. Status: ' || coalesce(enrollment_status, 'Unknown') || '. GPA: ' || "
        "coalesce(CAST(gpa AS VARCHAR), 'N/A') || '. Email: ' || coalesce(email, 'N/A')"),
}


def _bm25(docs: str, questions: str, *inputs: str, where: str = "") -> str:
    """``docs`` selects doc_id, title, txt and attributes; ``questions`` selects the query text as q."""
    words = "list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> '')"
    return with_ctes(f"""WITH docs AS ({docs}),
      toks AS (SELECT *, {words.format('txt')} AS ws FROM docs WHERE txt IS NOT NULL),
      post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM toks) GROUP BY doc_id, term),
      freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
      size AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(len(ws)) AS DOUBLE) / count(*) AS avg_len FROM toks),
      asked AS (SELECT DISTINCT q AS query_id, unnest({words.format('q')}) AS term FROM ({questions})),
      scored AS (
        SELECT asked.query_id, post.doc_id,
          round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / avg_len))), 6) AS score
        FROM asked JOIN post ON asked.term = post.term JOIN freq ON freq.term = asked.term JOIN toks ON toks.doc_id = post.doc_id, size
        {where} GROUP BY asked.query_id, post.doc_id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rk FROM scored)
      SELECT query_id, {big('rk')} AS rank, ranked.doc_id, docs.title, score FROM ranked JOIN docs ON docs.doc_id = ranked.doc_id
      WHERE rk <= 10""", *inputs)


def _words(*columns: str) -> str:
    return f"concat_ws(' ', {', '.join(columns)})"


# --- cost ---------------------------------------------------------------------------------------

AS_OF = f"DATE '{tbd.AS_OF}'"
SECONDS = "date_diff('second', {0}, {1})"


def _since(days: int) -> str:
    return f"CAST({AS_OF} - INTERVAL '{days}' DAY AS TIMESTAMP)"


def _owned(name: str, kind: str | None = None) -> str:
    match = f"r.resource_name = x.{name}" + (f" AND r.resource_type = '{kind}'" if kind else "")
    return f"LEFT JOIN rules r ON {match}"


def _snapshot(source: str, name: str, kind: str) -> str:
    return (f"SELECT CAST(start_time AS DATE) AS snapshot_date, '{kind}' AS resource_type, {name} AS resource_name, "
            f"sum(credits_used) AS credits_used, cost_center, department, project FROM {source} x {_owned(name)} "
            f"WHERE {name} LIKE 'DEMO_%' GROUP BY ALL")


SNAPSHOTS = (f"snaps AS ({_snapshot('warehouse_metering', 'warehouse_name', 'WAREHOUSE')} UNION ALL "
             f"{_snapshot('container_history', 'compute_pool_name', 'CONTAINER')})")
SNAPSHOT_INPUTS = ("warehouse_metering", "container_history", "rules")
ALERT_TIME = "TIMESTAMP '2024-01-30 23:30:00'"


def _alert(kind: str, since: str, period: str, limit: int, text: str, acknowledged: str = "false") -> str:
    return (f"SELECT '{kind}' AS alert_type, 'WAREHOUSE' AS resource_type, warehouse_name AS resource_name, "
            f"{period} AS period, {dbl(limit)} AS threshold_value, {dbl('usd')} AS current_value, "
            f"'{text} for warehouse ' || warehouse_name || ': $' || CAST(CAST(usd AS DECIMAL(15,2)) AS VARCHAR) AS alert_message, "
            f"{ALERT_TIME} AS alert_timestamp, {acknowledged} AS acknowledged FROM (SELECT warehouse_name, sum(credits_used) * 3 AS usd "
            f"FROM warehouse_metering WHERE start_time >= {since} AND warehouse_name LIKE 'DEMO_%' GROUP BY warehouse_name) WHERE usd > {limit}")


MIDNIGHT = "TIMESTAMP '2024-01-30 00:00:00'"
DAILY = _alert("DAILY_THRESHOLD_EXCEEDED", MIDNIGHT, MIDNIGHT, 50, "Daily cost threshold exceeded")
HOURLY = _alert("HOURLY_SPIKE", "TIMESTAMP '2024-01-30 22:30:00'", "TIMESTAMP '2024-01-30 23:00:00'", 10, "Unusual hourly cost spike")


def _counts(tables: dict[str, str], *inputs: str) -> str:
    return with_ctes(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {big('count(*)')} AS record_count FROM {t}" for n, t in tables.items()), *inputs)


def _constraints() -> str:
    rows = []
    for name, spec in ENTITIES.items():
        def row(kind: str, column: str, body: str) -> None:
            rows.append(f"SELECT '{spec.table}' AS table_name, '{column}' AS column_name, '{kind}' AS constraint_type, "
                        f"{big('count(*)')} AS violations FROM ({body})")
        row("NOT_NULL", spec.key, f"SELECT 1 FROM {name} WHERE {spec.key} IS NULL")
        row("UNIQUE", spec.key, f"SELECT 1 FROM {name} WHERE {spec.key} IS NOT NULL GROUP BY {spec.key} HAVING count(*) > 1")
        for fk, (dim, natural) in spec.lookups.items():
            row("FOREIGN_KEY", fk, f"SELECT 1 FROM {name} f WHERE f.{natural} IS NOT NULL AND NOT EXISTS "
                                   f"(SELECT 1 FROM {dim} d WHERE d.{natural} = f.{natural})")
    return with_ctes(" UNION ALL ".join(rows), *ENTITIES)


def _rate(state: str, dims: str, name: str, tail: str = "") -> str:
    return with_ctes(
        f"SELECT {dims}, {big('count(*)')} AS total_enrollments, {big(f'''count(*) FILTER (enrollment_status = '{state}')''')} AS {state}_count, "
        + half_up(f"count(*) FILTER (enrollment_status = '{state}') * 100", "count(*)", 2)
        + f" AS {name} FROM v_enrollments GROUP BY {dims} {tail}", "v_enrollments")


def _means(column: str, scale: int, digits: int = 2) -> str:
    return half_up(cents(f"sum({column})", digits), f"count({column}) * {10 ** digits}", scale)


def _gb(expr: str, unit: int, scale: int) -> str:
    return half_up(expr, str(unit), scale)


QUIZ_IDS = "activity_type = 'Quiz'"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["land_raw"] = with_ctes(
        f"SELECT 'raw-' || student_id AS raw_id, 'CANVAS_LMS' AS source_system, 'students.json' AS file_name, {NOW_SQL} AS ingested_at, "
        "'PENDING' AS processing_status, student_id FROM students", "students")
    for e in ENTITIES:
        sql[f"extract_{e}"] = with_ctes(f"SELECT {_typed(e)} FROM {e} WHERE {RAW_STATUS[e]} = 'PENDING'", e)
    sql["validate_raw_json"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{e}' AS table_name, {big('count(*)')} AS total_rows, "
        + (f"{big(f'count(*) FILTER (NOT {QUIZ_IDS})')} AS valid_rows, {big(f'count(*) FILTER ({QUIZ_IDS})')}" if e == "activity_logs"
           else f"{big('count(*)')} AS valid_rows, {big('0')}") + f" AS malformed_rows FROM {e}" for e in ENTITIES), *ENTITIES)
    sql["rejected_rows"] = with_ctes(
        f"SELECT 'feed-' || activity_id AS raw_id, 'MALFORMED_JSON' AS reason FROM activity_logs WHERE {QUIZ_IDS}", "activity_logs")
    sql["raw_preview"] = with_ctes(
        f"SELECT student_id, first_name, last_name, major, {dbl('gpa')} AS gpa FROM students ORDER BY student_id LIMIT 10", "students")

    for e, spec in ENTITIES.items():
        if spec.updates:
            sql[f"upsert_{e}"] = _merge(e)
    sql["upsert_enrollments_narrow"] = _merge("enrollments", "sql")
    sql["upsert_submissions_narrow"] = _merge("submissions", "sql")
    sql["insert_new_activity"] = _merge("activity_logs")
    fields = _typed("activity_logs")
    sql["append_activity"] = with_ctes(
        f"SELECT {fields} FROM activity_logs WHERE {STORED['activity_logs']} UNION ALL SELECT {fields} FROM activity_logs "
        f"WHERE {RESENT['activity_logs']}", "activity_logs")
    extra, joins = _lookup("enrollments", "x")
    sql["backfill_keys"] = with_ctes(
        f"SELECT x.enrollment_id, x.student_id, x.course_id{extra} FROM enrollments x{joins}", "enrollments", "students", "courses")
    sql["assigned_keys"] = with_ctes(
        f"SELECT {big('count(*)')} AS row_count, {big('count(*)')} AS key_count, {big('0')} AS open_keys FROM students "
        f"WHERE {STORED['students']} OR {RESENT['students']}", "students")
    sql["pending_counts"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{e}' AS table_name, {big('count(*)')} AS pending FROM {e} WHERE {RAW_STATUS[e]} = 'PENDING'" for e in ENTITIES), *ENTITIES)
    sql["mark_processed"] = with_ctes("SELECT 'feed-' || enrollment_id AS raw_id, 'PROCESSED' AS processing_status FROM enrollments", "enrollments")
    sql["mark_bound_batch"] = with_ctes(
        f"SELECT 'feed-' || enrollment_id AS raw_id, CASE WHEN {STORED['enrollments']} THEN 'PROCESSED' ELSE {RAW_STATUS['enrollments']} END "
        "AS processing_status FROM enrollments", "enrollments")
    sql["mark_error"] = with_ctes(
        f"SELECT 'feed-' || activity_id AS raw_id, CASE WHEN {QUIZ_IDS} THEN 'ERROR' ELSE 'PENDING' END AS processing_status FROM activity_logs",
        "activity_logs")
    touched = "enrollment_status = 'Active' AND major <> 'MACHINERY'"
    sql["touch_active_students"] = with_ctes(
        f"SELECT student_id, {touched} AS is_current, CASE WHEN {touched} OR major = 'MACHINERY' THEN {LATER_SQL} ELSE {NOW_SQL} END "
        "AS updated_at FROM students", "students")
    sql["refresh_current_courses"] = with_ctes(
        f"SELECT course_id, true AS is_current, CASE WHEN department = 'PROMO' OR NOT is_current THEN {LATER_SQL} ELSE {NOW_SQL} END "
        "AS updated_at FROM courses", "courses")

    stamped = f"{PERFORMANCE_OUT}, {NOW_SQL} AS calculated_at"
    sql["student_course_performance"] = _on_performance(f"SELECT {stamped} FROM perf")
    sql["student_course_performance_compat"] = _on_performance(f"SELECT {stamped} FROM perf", FAN_OUT)
    rollup_in = ("courses", "enrollments", "engagement")
    counts = ["total_enrolled", "active_students", "avg_engagement_minutes", "at_risk_students", *[f"grade_{b}" for b in BANDS]]
    sql["course_analytics"] = with_ctes(
        f"WITH {COURSE_ROLLUP.strip()} SELECT course_id, term, avg_class_score, median_class_score, completion_rate, "
        + ", ".join(f"{big(c)} AS {c}" for c in counts) + f", {NOW_SQL} AS calculated_at FROM rollup_", *rollup_in)
    sql["student_risk"] = _on_performance(
        f"SELECT student_id, {mean('CAST(avg_score AS DECIMAL(5,2))')} AS overall_avg_score, {big('sum(late_submissions)')} AS total_late, "
        f"{big('sum(missing_submissions)')} AS total_missing, {mean('total_activity_minutes')} AS avg_activity FROM perf GROUP BY student_id "
        "HAVING overall_avg_score < 70 OR total_late > 5 OR total_missing > 3")
    sql["grade_distribution"] = with_ctes(
        "SELECT course_id, " + ", ".join(f"{big(f'count(*) FILTER (final_grade IN {g})')} AS grade_{b}" for b, g in BANDS.items())
        + " FROM enrollments GROUP BY course_id", "enrollments")
    sql["engagement_minutes"] = with_ctes(f"SELECT student_id, course_id, {big('total_minutes')} AS total_minutes FROM engagement", "engagement")

    orphans = "FROM enrollments e WHERE NOT EXISTS (SELECT 1 FROM students s WHERE s.student_id = e.student_id)"
    sql["dq_orphaned_enrollments"] = with_ctes(
        "SELECT 'ORPHANED_ENROLLMENTS' AS check_name, enrollment_id AS record_id, '{\"enrollment_id\":\"' || enrollment_id || '\"}' AS details "
        + orphans, "enrollments", "students")
    sql["dq_duplicate_students"] = with_ctes(
        f"SELECT 'DUPLICATE_STUDENT_IDS' AS check_name, student_id AS record_id FROM students WHERE {STORED['students']} AND {RESENT['students']}",
        "students")
    bad_gpa = "FROM students WHERE gpa < 0 OR gpa > 4.0"
    sql["dq_invalid_gpa"] = with_ctes(
        f"SELECT 'INVALID_GPA_VALUES' AS check_name, student_id AS record_id, {dbl('gpa')} AS gpa {bad_gpa}", "students")
    sql["dq_report"] = with_ctes(
        f"SELECT 'ORPHANED_ENROLLMENTS' AS check_name, {NOW_SQL} AS check_timestamp, {big('count(*)')} AS issues_found {orphans} UNION ALL "
        f"SELECT 'DUPLICATE_STUDENT_IDS', {NOW_SQL}, {big('count(*)')} FROM (SELECT student_id FROM students GROUP BY student_id HAVING count(*) > 1) "
        f"UNION ALL SELECT 'INVALID_GPA_VALUES', {NOW_SQL}, {big('count(*)')} {bad_gpa}", "enrollments", "students")
    sql["dq_thresholds"] = with_ctes(
        "SELECT name, CAST(value AS DOUBLE) AS value, threshold, value <= threshold AS passed FROM ("
        "SELECT 'no_final_score' AS name, count(*) FILTER (final_score IS NULL) AS value, CAST(100 AS DOUBLE) AS threshold FROM enrollments UNION ALL "
        "SELECT 'score_out_of_range', count(*) FILTER (final_score < 0 OR final_score > 100), 0 FROM enrollments UNION ALL "
        "SELECT 'no_student', count(*) FILTER (student_id IS NULL), 0 FROM enrollments)", "enrollments")
    sql["linkage_check"] = with_ctes(
        f"SELECT 'Enrollment Linkage Check' AS check_name, {big('count(*)')} AS total_enrollments, {big('count(x.course_id)')} AS with_course_id, "
        f"{big('count(c.course_key)')} AS with_course_key, {big('count(x.student_id)')} AS with_student_id, {big('count(s.student_key)')} "
        "AS with_student_key FROM enrollments x LEFT JOIN students s ON x.student_id = s.student_id LEFT JOIN courses c ON x.course_id = c.course_id",
        "enrollments", "students", "courses")
    sql["constraint_report"] = sql["job_constraints"] = _constraints()
    sql["table_counts"] = _counts({e: e for e in ENTITIES}, *ENTITIES)
    sql["raw_table_counts"] = _counts({f"raw_{e}": e for e in ENTITIES}, *ENTITIES)
    sql["data_summary"] = with_ctes(
        "SELECT " + ", ".join(f"(SELECT {big('count(*)')} FROM {e}) AS {e}" for e in ENTITIES), *ENTITIES)
    sql["submission_pairs"] = with_ctes(
        f"SELECT DISTINCT e.student_id, a.assignment_id, {dbl('a.points_possible')} AS points_possible FROM enrollments e JOIN assignments a "
        "ON e.course_id = a.course_id WHERE a.assignment_type <> 'Quiz'", "enrollments", "assignments")

    runs = (
        "run_id, run_type, started_at, CASE WHEN final_status IS NOT NULL THEN started_at + INTERVAL '1' HOUR END AS completed_at, "
        "coalesce(final_status, 'STARTED') AS status, CAST(CASE WHEN final_status IS NULL THEN 0 ELSE records_processed END AS BIGINT) "
        "AS records_processed, CASE WHEN final_status = 'FAILED' THEN 'run ' || run_id || ' failed' END AS error_message")
    sql["etl_run_log"] = with_ctes(f"SELECT {runs} FROM runs", "runs")
    sql["job_status"] = with_ctes(
        f"SELECT CASE WHEN count(*) FILTER (final_status IS NULL) > 0 THEN 'running' ELSE 'idle' END AS status, max(started_at) AS last_run, "
        f"{big('''sum(CASE WHEN final_status = 'COMPLETED' THEN records_processed ELSE 0 END)''')} AS records_processed, "
        f"{big('''count(*) FILTER (final_status = 'FAILED')''')} AS errors, {big('count(*) FILTER (final_status IS NULL)')} AS running_jobs FROM runs",
        "runs")
    sql["recent_runs"] = with_ctes(
        f"SELECT {runs} FROM runs WHERE run_type = 'DEPLOYMENT' ORDER BY started_at DESC, run_id LIMIT 5", "runs")
    sql["service_log_parse"] = "SELECT ts AS timestamp, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity, event_type || ' ' || props AS message FROM events"

    credits = f"{dbl('sum(credits_used)')} AS total_credits, {dbl('sum(credits_used) * 3')} AS estimated_cost_usd"
    duration = SECONDS.format("start_time", "end_time")
    sql["usage_hourly"] = with_ctes(
        f"SELECT date_trunc('hour', start_time) AS usage_hour, warehouse_name, {credits}, {big('count(*)')} AS query_count, "
        f"{mean(duration)} AS avg_query_duration_sec FROM warehouse_metering WHERE start_time >= {_since(7)} AND warehouse_name LIKE 'DEMO_%' "
        "GROUP BY 1, 2", "warehouse_metering")
    sql["warehouse_daily_costs"] = with_ctes(
        "WITH d AS (SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name, cost_center, department, project, sum(credits_used) AS credits "
        f"FROM warehouse_metering x {_owned('warehouse_name', 'WAREHOUSE')} WHERE start_time >= {_since(30)} AND warehouse_name LIKE 'DEMO_%' GROUP BY ALL), "
        "t AS (SELECT *, sum(credits) OVER (PARTITION BY usage_date) AS day_credits FROM d) "
        f"SELECT {ts('usage_date')} AS usage_date, warehouse_name, cost_center, department, project, {dbl('credits')} AS total_credits, "
        f"{dbl('credits * 3')} AS estimated_cost_usd, {half_up(cents('credits') + ' * 100', cents('day_credits'), 2)} AS pct_of_daily_spend FROM t",
        "warehouse_metering", "rules")
    default_rules = ", ".join(f"('DEMO_{n}_WH', 'DATA_PLATFORM', 'IT', 'CANVAS_ETL')" for n in ("INGESTION", "TRANSFORM", "TASK"))
    sql["cost_default_rules"] = with_ctes(
        f"WITH named AS (SELECT * REPLACE ({DEFAULT_NAMES} AS warehouse_name) FROM warehouse_metering), "
        f"r(resource_name, cost_center, department, project) AS (VALUES {default_rules}), "
        "d AS (SELECT CAST(start_time AS DATE) AS usage_date, warehouse_name, cost_center, department, project, sum(credits_used) AS credits "
        f"FROM named x LEFT JOIN r ON r.resource_name = x.warehouse_name WHERE start_time >= {_since(30)} GROUP BY ALL), "
        "t AS (SELECT *, sum(credits) OVER (PARTITION BY usage_date) AS day_credits FROM d) "
        f"SELECT {ts('usage_date')} AS usage_date, warehouse_name, cost_center, department, project, {dbl('credits')} AS total_credits, "
        f"{dbl('credits * 3')} AS estimated_cost_usd, {half_up(cents('credits') + ' * 100', cents('day_credits'), 2)} AS pct_of_daily_spend FROM t",
        "warehouse_metering")
    sql["monthly_trends"] = with_ctes(
        "WITH m AS (SELECT date_trunc('month', start_time) AS usage_month, warehouse_name, sum(credits_used) AS credits FROM warehouse_metering_long "
        f"WHERE start_time >= CAST(DATE '{tbd.ORDERS_AS_OF}' - INTERVAL '12' MONTH AS TIMESTAMP) AND warehouse_name LIKE 'DEMO_%' GROUP BY 1, 2), "
        "p AS (SELECT *, lag(credits) OVER (PARTITION BY warehouse_name ORDER BY usage_month) AS prev FROM m) "
        f"SELECT {ts('usage_month')} AS usage_month, warehouse_name, {dbl('credits')} AS total_credits, {dbl('credits * 3')} AS estimated_cost_usd, "
        f"{dbl('prev')} AS prev_month_credits, {half_up(cents('(credits - prev)') + ' * 100', cents('prev'), 2)} AS mom_change_pct FROM p",
        "warehouse_metering_long")
    sql["pool_usage_hourly"] = with_ctes(
        f"SELECT date_trunc('hour', start_time) AS usage_hour, compute_pool_name, {credits}, {mean('active_node_count')} AS avg_active_nodes, "
        f"{big('max(active_node_count)')} AS max_active_nodes FROM container_history WHERE start_time >= {_since(30)} "
        "AND compute_pool_name LIKE 'DEMO_%' GROUP BY 1, 2", "container_history")
    sql["container_daily_costs"] = with_ctes(
        f"SELECT {ts('CAST(start_time AS DATE)')} AS usage_date, compute_pool_name, cost_center, department, project, {credits}, "
        f"{dbl('sum(credits_used_compute)')} AS compute_credits, {dbl('sum(credits_used_cloud_services)')} AS cloud_services_credits "
        f"FROM container_history x {_owned('compute_pool_name', 'COMPUTE_POOL')} WHERE start_time >= {_since(30)} AND compute_pool_name LIKE 'DEMO_%' "
        "GROUP BY ALL", "container_history", "rules")
    run_time = SECONDS.format("query_start_time", "completed_time")
    sql["task_costs"] = with_ctes(
        f"SELECT {ts('CAST(query_start_time AS DATE)')} AS execution_date, database_name, schema_name, name AS task_name, state, "
        f"{big('count(*)')} AS execution_count, {credits}, {mean(run_time)} AS avg_duration_sec, {big('''count(*) FILTER (state = 'FAILED')''')} "
        f"AS failed_count FROM task_history WHERE query_start_time >= {_since(30)} AND database_name = 'DEMO_CANVAS_DB' GROUP BY ALL", "task_history")
    sql["task_failures"] = with_ctes(
        f"SELECT scheduled_time, name AS task_name, schema_name, state, error_code, error_message, {big(run_time)} AS duration_sec FROM task_history "
        f"WHERE database_name = 'DEMO_CANVAS_DB' AND state = 'FAILED' AND scheduled_time >= {_since(7)}", "task_history")
    live, spare = "average_database_bytes", "average_failsafe_bytes"
    sql["storage_costs"] = with_ctes(
        f"SELECT {ts('usage_date')} AS usage_date, database_name, {_gb(live, 1024**3, 4)} AS storage_gb, {_gb(spare, 1024**3, 4)} AS failsafe_gb, "
        f"{_gb(f'{live} + {spare}', 1024**4, 4)} AS total_tb, {_gb(f'({live} + {spare}) * 23', 1024**4, 2)} AS estimated_monthly_cost_usd "
        f"FROM database_storage WHERE database_name = 'DEMO_CANVAS_DB' AND usage_date >= {AS_OF} - INTERVAL '30' DAY", "database_storage")
    sizes = (
        f"SELECT table_catalog AS database_name, table_schema, table_name, {_gb('active_bytes', 1024**2, 2)} AS active_mb, "
        f"{_gb('time_travel_bytes', 1024**2, 2)} AS time_travel_mb, {_gb('failsafe_bytes', 1024**2, 2)} AS failsafe_mb, "
        f"{_gb('active_bytes + time_travel_bytes + failsafe_bytes', 1024**2, 2)} AS total_mb, {big('row_count')} AS row_count, "
        f"{half_up('active_bytes', 'row_count', 2)} AS bytes_per_row FROM table_storage WHERE table_catalog = 'DEMO_CANVAS_DB' AND deleted IS NULL")
    sql["table_storage"] = with_ctes(sizes, "table_storage")
    sql["top_tables"] = with_ctes(f"{sizes} ORDER BY total_mb DESC, table_name LIMIT 20", "table_storage")
    total = "SELECT '{0}' AS resource_type, {1} AS resource_name, sum(credits_used) AS credits FROM {2} WHERE {3} GROUP BY 2"
    costs = " UNION ALL ".join([
        total.format("WAREHOUSE", "warehouse_name", "warehouse_metering", f"start_time >= {_since(30)} AND warehouse_name LIKE 'DEMO_%'"),
        total.format("CONTAINER", "compute_pool_name", "container_history", f"start_time >= {_since(30)} AND compute_pool_name LIKE 'DEMO_%'"),
        total.format("TASK", "name", "task_history", f"query_start_time >= {_since(30)} AND database_name = 'DEMO_CANVAS_DB'"),
    ])
    sql["cost_dashboard"] = with_ctes(
        f"WITH c AS ({costs}), o AS (SELECT x.*, r.cost_center, r.department, r.project FROM c x {_owned('resource_name')}), "
        "t AS (SELECT *, sum(credits) OVER () AS grand FROM o) "
        f"SELECT resource_type, resource_name, cost_center, department, project, {dbl('credits')} AS total_credits, {dbl('credits * 3')} "
        f"AS estimated_cost_usd, {half_up(cents('credits') + ' * 100', cents('grand'), 2)} AS pct_of_total FROM t",
        "warehouse_metering", "container_history", "task_history", "rules")
    sql["alert_daily_threshold"] = with_ctes(DAILY, "warehouse_metering")
    sql["alert_hourly_spike"] = with_ctes(HOURLY, "warehouse_metering")
    sql["open_alerts"] = with_ctes(f"SELECT * FROM ({DAILY} UNION ALL {HOURLY}) WHERE resource_name <> 'DEMO_VIEW_WH'", "warehouse_metering")
    sql["new_alerts"] = with_ctes(HOURLY, "warehouse_metering")
    snap = (f"SELECT {ts('snapshot_date')} AS snapshot_date, resource_type, resource_name, {dbl('credits_used')} AS credits_used, "
            f"{dbl('credits_used * 3')} AS estimated_cost_usd, cost_center, department, project FROM snaps "
            "WHERE snapshot_date = DATE '2024-01-30' AND resource_type = ")
    sql["snapshot_warehouse"] = with_ctes(f"WITH {SNAPSHOTS} {snap}'WAREHOUSE'", *SNAPSHOT_INPUTS)
    sql["snapshot_container"] = with_ctes(f"WITH {SNAPSHOTS} {snap}'CONTAINER'", *SNAPSHOT_INPUTS)
    summed = f"{dbl('sum(credits_used)')} AS total_credits, {dbl('sum(credits_used) * 3')} AS total_cost_usd"
    sql["cost_summary_7d"] = with_ctes(
        f"WITH {SNAPSHOTS} SELECT resource_type, resource_name, {summed} FROM snaps WHERE snapshot_date >= {AS_OF} - INTERVAL '7' DAY GROUP BY 1, 2",
        *SNAPSHOT_INPUTS)
    sql["cost_by_project"] = with_ctes(
        f"WITH {SNAPSHOTS} SELECT project, department, {summed}, {big('count(DISTINCT resource_name)')} AS resource_count FROM snaps "
        f"WHERE snapshot_date >= {AS_OF} - INTERVAL '30' DAY GROUP BY 1, 2", *SNAPSHOT_INPUTS)
    sql["service_metrics"] = with_ctes(
        f"SELECT start_time, end_time, {dbl('credits_used')} AS credits_used, {dbl('credits_used_cloud_services')} AS credits_used_cloud_services, "
        f"{dbl('credits_used_compute')} AS credits_used_compute FROM serverless_history WHERE database_name = 'DEMO_CANVAS_DB'", "serverless_history")

    sql["students_base"] = with_ctes(
        f"SELECT * REPLACE ({big('canvas_user_id')} AS canvas_user_id, {dbl('gpa')} AS gpa, {ts('enrollment_date')} AS enrollment_date, "
        f"{ts('expected_graduation')} AS expected_graduation) FROM v_students", "v_students")
    sql["courses_base"] = with_ctes(f"SELECT {_typed('courses')}, is_current FROM courses", "courses")
    sql["enrollments_base"] = with_ctes(
        f"SELECT * REPLACE ({dbl('final_score')} AS final_score, {dbl('grade_points')} AS grade_points, {big('credit_hours')} AS credit_hours) "
        "FROM v_enrollments", "v_enrollments")
    sql["submissions_base"] = with_ctes(
        f"SELECT * REPLACE ({dbl('score')} AS score, {dbl('percentage')} AS percentage, {dbl('points_possible')} AS points_possible, "
        f"{big('attempt_number')} AS attempt_number) FROM v_submissions", "v_submissions")
    numbers = ["total_assignments", "completed_assignments", "late_submissions", "missing_submissions", "total_activity_minutes"]
    doubles = ["average_score", "total_points_earned", "total_points_possible", "completion_rate", "overall_gpa"]
    sql["performance_base"] = _on_view(
        "SELECT * REPLACE (" + ", ".join([*[f"{big(c)} AS {c}" for c in numbers], *[f"{dbl(c)} AS {c}" for c in doubles],
                                          f"{ts('last_activity_date')} AS last_activity_date"]) + ") FROM v_perf")
    n = big("count(*)")
    sql["metrics_student"] = with_ctes(
        f"SELECT major, academic_standing, {n} AS total_students, {mean('gpa')} AS average_gpa, "
        f"{big('''count(*) FILTER (enrollment_status = 'Active')''')} AS active_students, {big('count(*) FILTER (gpa < 2.0)')} AS at_risk_students, "
        f"{big('count(*) FILTER (gpa >= 3.5)')} AS deans_list_students FROM v_students GROUP BY 1, 2", "v_students")
    sql["metrics_course"] = with_ctes(
        f"SELECT department, term, {n} AS total_courses, {big('sum(credit_hours)')} AS total_credit_hours, {big('sum(max_enrollment)')} AS total_capacity, "
        f"{big('count(*) FILTER (is_current)')} AS current_courses, {big('count(DISTINCT instructor_name)')} AS unique_instructors FROM courses GROUP BY 1, 2",
        "courses")
    sql["metrics_enrollment"] = with_ctes(
        f"SELECT term, department, grade_category, {n} AS total_enrollments, {big('count(DISTINCT student_id)')} AS unique_students, "
        f"{big('count(DISTINCT course_id)')} AS unique_courses, {mean('grade_points')} AS average_grade_points, {big('sum(credit_hours)')} "
        "AS total_credit_hours FROM v_enrollments WHERE enrollment_status <> 'dropped' GROUP BY 1, 2, 3", "v_enrollments")
    sql["metrics_submission"] = with_ctes(
        f"SELECT assignment_type, score_category, student_major, {n} AS total_submissions, {big('count(DISTINCT student_id)')} "
        f"AS unique_students_submitted, {mean('score')} AS average_score, {big('count(*) FILTER (late_flag)')} AS late_submission_count "
        "FROM v_submissions GROUP BY 1, 2, 3", "v_submissions")
    score = "CAST(average_score AS DECIMAL(5,2))"
    sql["metrics_performance"] = _on_view(
        f"SELECT department, term, classification, {n} AS total_records, {mean(score)} AS avg_course_score, {big('sum(late_submissions)')} "
        f"AS total_late_submissions, {big('count(*) FILTER (average_score < 60)')} AS students_at_risk, "
        f"{big('count(*) FILTER (average_score >= 90)')} AS high_performers FROM v_perf GROUP BY 1, 2, 3")
    sql["metrics_runtime"] = with_ctes(
        "SELECT CASE WHEN gpa >= 3.5 THEN 'Dean''s List' WHEN gpa >= 2.0 THEN 'Good Standing' ELSE 'Academic Probation' END AS academic_standing, "
        f"classification, {n} AS total_students, {big('count(*) FILTER (gpa < 2.0)')} AS at_risk_count FROM students GROUP BY 1, 2", "students")
    sql["metrics_facts"] = with_ctes(
        f"SELECT course_id, instructor_name AS instructor, {big('credit_hours')} AS course_credits, {big('max_enrollment')} AS max_seats FROM courses",
        "courses")

    sql["enrollment_detail"] = with_ctes(
        f"SELECT e.enrollment_id, s.first_name || ' ' || s.last_name AS student_name, c.course_code, c.course_name, e.enrollment_state, e.final_grade, "
        f"{dbl('e.final_score')} AS final_score FROM enrollments e JOIN students s ON e.student_id = s.student_id "
        "JOIN courses c ON e.course_id = c.course_id", "enrollments", "students", "courses")
    sql["performance_by_major"] = _on_performance(
        f"SELECT major, {n} AS student_count, {_means('gpa', 2)} AS avg_gpa, {_means('CAST(avg_score AS DECIMAL(5,2))', 1)} AS avg_course_score "
        "FROM students s LEFT JOIN perf p ON s.student_id = p.student_id GROUP BY major")
    sql["course_report"] = with_ctes(
        f"WITH {COURSE_ROLLUP.strip()} SELECT a.course_id, c.course_code, c.course_name, {big('total_enrolled')} AS total_enrolled, "
        f"{big('active_students')} AS active_students, avg_class_score, completion_rate, {big('at_risk_students')} AS at_risk_students "
        "FROM rollup_ a JOIN courses c ON a.course_id = c.course_id", *rollup_in)
    sql["at_risk_students"] = _on_performance(
        f"SELECT s.student_id, p.course_id, s.first_name || ' ' || s.last_name AS student_name, s.major, {dbl('s.gpa')} AS gpa, p.avg_score, "
        f"{big('p.late_submissions')} AS late_submissions, {big('p.missing_submissions')} AS missing_submissions, p.current_grade "
        "FROM students s JOIN perf p ON s.student_id = p.student_id WHERE p.avg_score < 70 OR p.late_submissions > 3 OR p.missing_submissions > 2")
    sql["top_courses"] = with_ctes(
        f"SELECT c.course_code, c.course_name, c.department, {n} AS enrollment_count FROM enrollments e JOIN courses c ON e.course_id = c.course_id "
        "GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 10", "enrollments", "courses")
    sql["enrollment_sample"] = with_ctes(
        "SELECT e.enrollment_id, e.student_id, e.course_id, c.course_code, c.course_name, c.department FROM enrollments e "
        "LEFT JOIN courses c ON e.course_id = c.course_id ORDER BY 1 LIMIT 10", "enrollments", "courses")
    sql["students_by_major"] = with_ctes(
        f"SELECT major, {n} AS student_count, {_means('gpa', 2)} AS avg_gpa, {big('count(*) FILTER (gpa < 2.0)')} AS at_risk_count, "
        f"{big('count(*) FILTER (gpa >= 3.5)')} AS deans_list_count FROM students GROUP BY major ORDER BY 2 DESC, 1 LIMIT 10", "students")
    sql["courses_by_department"] = with_ctes(
        f"SELECT department, {n} AS course_count, {big('sum(credit_hours)')} AS total_credits, {big('count(DISTINCT instructor_name)')} "
        "AS instructor_count FROM courses GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "courses")
    sql["enrollments_by_term"] = with_ctes(
        f"SELECT term, department, {n} AS enrollment_count, {big('count(DISTINCT student_id)')} AS unique_students, {_means('grade_points', 2, 1)} "
        "AS avg_grade_points FROM v_enrollments WHERE term IS NOT NULL GROUP BY 1, 2 ORDER BY 1 DESC, 3 DESC, 2 LIMIT 20", "v_enrollments")
    sql["submissions_by_type"] = with_ctes(
        f"SELECT assignment_type, {n} AS submission_count, {_means('percentage', 1)} AS avg_percentage, {big('count(*) FILTER (late_flag)')} "
        "AS late_count FROM v_submissions WHERE assignment_type IS NOT NULL GROUP BY 1", "v_submissions")
    sql["performance_by_dept"] = _on_view(
        f"SELECT department, term, {n} AS record_count, {_means(score, 1)} AS avg_score, {big('count(*) FILTER (average_score < 60)')} AS at_risk, "
        f"{big('count(*) FILTER (average_score >= 90)')} AS high_performers FROM v_perf WHERE term IS NOT NULL GROUP BY 1, 2 "
        "ORDER BY 2 DESC, 3 DESC, 1 LIMIT 20")
    sql["gpa_by_major"] = with_ctes(f"SELECT major, {mean('gpa')} AS average_gpa, {n} AS total_students FROM students GROUP BY 1", "students")
    sql["students_on_probation"] = with_ctes(
        f"SELECT student_id, full_name, major, {dbl('gpa')} AS gpa FROM v_students WHERE academic_standing = 'Academic Probation'", "v_students")
    sql["most_active_instructors"] = with_ctes(
        f"SELECT instructor_name, {n} AS total_courses, {big('sum(credit_hours)')} AS total_credit_hours FROM courses GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 10", "courses")
    sql["late_rate_by_type"] = with_ctes(
        f"SELECT assignment_type, {n} AS total_submissions, {big('count(*) FILTER (late_flag)')} AS late_submission_count, "
        f"{half_up('count(*) FILTER (late_flag) * 100', 'count(*)', 2)} AS late_rate_pct FROM v_submissions GROUP BY 1", "v_submissions")
    sql["highest_enrollment"] = with_ctes(
        f"SELECT course_id, course_name, {n} AS total_enrollments FROM v_enrollments GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10", "v_enrollments")
    sql["completion_by_department"] = _rate("completed", "department", "completion_rate_pct")
    sql["dropout_rate"] = _rate("dropped", "course_id, course_name", "dropout_rate_pct",
                                "ORDER BY dropout_rate_pct DESC, total_enrollments DESC, course_id LIMIT 10")
    sql["enrollment_by_classification"] = with_ctes(
        f"SELECT student_classification, {n} AS total_enrollments, {big('count(DISTINCT student_id)')} AS unique_students FROM v_enrollments GROUP BY 1",
        "v_enrollments")
    sql["term_trend"] = with_ctes(
        f"SELECT term, min(enrollment_date) AS first_enrolled, {n} AS total_enrollments, {big('count(DISTINCT student_id)')} AS unique_students "
        "FROM v_enrollments WHERE term IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 3", "v_enrollments")
    sql["top_students_by_department"] = with_ctes(
        f"SELECT department, student_id, avg_final_score, graded_courses, {big('rk')} AS rank FROM (SELECT *, row_number() OVER (PARTITION BY department "
        "ORDER BY avg_final_score DESC, graded_courses DESC, student_id) AS rk FROM ("
        f"SELECT department, student_id, {_means('final_score', 2)} AS avg_final_score, {n} AS graded_courses FROM v_enrollments "
        "WHERE final_score IS NOT NULL AND department IS NOT NULL GROUP BY 1, 2)) WHERE rk <= 10", "v_enrollments")
    sql["pass_rate"] = with_ctes(
        f"SELECT department, {big('count(final_score)')} AS graded, {big('count(*) FILTER (final_score >= 60)')} AS passed, "
        f"{half_up('count(*) FILTER (final_score >= 60) * 100', 'count(final_score)', 2)} AS pass_rate_pct FROM v_enrollments GROUP BY 1", "v_enrollments")

    text = lambda e: f"{TEXTS[e]} AS search_text"
    logged = ["activity_id", "student_id", "course_id", "activity_type", "activity_timestamp", "duration_seconds", "page_url", "device_type", "browser"]
    sql["activity_search_source"] = with_ctes(
        f"SELECT {_typed('activity_logs', logged)}, {text('activity_logs')}, {ts('CAST(activity_timestamp AS DATE)')} AS activity_date FROM activity_logs",
        "activity_logs")
    taught = [c for c in ENTITIES["courses"].fields if c != "instructor_id"]
    sql["course_search_source"] = with_ctes(f"SELECT {_typed('courses', taught)}, {text('courses')} FROM courses", "courses")
    sql["student_search_source"] = with_ctes(
        f"SELECT {_typed('students')}, first_name || ' ' || last_name AS full_name, {text('students')} FROM students", "students")
    asked = "SELECT DISTINCT {0} AS q FROM {1}"
    sql["search_students"] = _bm25(
        f"SELECT student_id AS doc_id, first_name || ' ' || last_name AS title, {TEXTS['students']} AS txt FROM students",
        asked.format(_words("major", "classification"), "students"), "students")
    sql["search_courses"] = _bm25(
        f"SELECT course_id AS doc_id, course_name AS title, term AS a_term, {TEXTS['courses']} AS txt FROM courses",
        asked.format(_words("department", "delivery_mode"), "courses"), "courses", where="WHERE a_term = 'Fall 2024'")
    activity_docs = f"SELECT activity_id AS doc_id, activity_type AS title, {TEXTS['activity_logs']} AS txt FROM activity_logs"
    activity_asked = asked.format(_words("activity_type", "device_type"), "activity_logs")
    sql["search_activity"] = _bm25(activity_docs, activity_asked, "activity_logs")
    sql["search_pruned"] = sql["search_activity"]
    advanced = TEXTS["courses"].replace("course_name", "name_now")
    name_now = f"CASE WHEN {RESENT['courses']} THEN course_name || ' advanced' ELSE course_name END"
    sql["search_refreshed"] = _bm25(
        f"SELECT course_id AS doc_id, name_now AS title, {advanced} AS txt FROM (SELECT *, {name_now} AS name_now FROM courses)",
        asked.format(_words("department", "course_name"), "courses"), "courses")

    sql["job_full_refresh"] = _on_performance(
        "SELECT 'FULL_REFRESH' AS name, 'COMPLETED' AS status, "
        + big(" + ".join(f"(SELECT count(*) FROM {e})" for e in ENTITIES)
              + " + (SELECT count(*) FROM perf) + (SELECT count(DISTINCT course_id) FROM enrollments WHERE course_id IN (SELECT course_id FROM courses))"
              " + (SELECT count(*) FROM (SELECT student_id FROM perf GROUP BY student_id HAVING "
              + mean("CAST(avg_score AS DECIMAL(5,2))") + " < 70 OR sum(late_submissions) > 5 OR sum(missing_submissions) > 3))")
        + " AS records_processed, " + ", ".join(f"(SELECT {big('count(*)')} FROM {e}) AS {e}" for e in ENTITIES)
        + f", (SELECT {big('count(*)')} FROM perf) AS perf_aggregations")
    sql["job_merge_submissions"] = _merge("submissions", columns=[
        "submission_id", "student_id", "assignment_id", "submitted_at", "graded_at", "score", "points_possible", "percentage", "late_flag",
        "updated_at"])
    checks = with_ctes(
        f"SELECT 'ORPHANED_ENROLLMENTS' AS check_name, {big('count(*)')} AS issues_found FROM enrollments e "
        "WHERE NOT EXISTS (SELECT 1 FROM students s WHERE s.student_id = e.student_id) UNION ALL SELECT 'DUPLICATE_STUDENT_IDS', "
        f"{big('count(*)')} FROM (SELECT student_id FROM students GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'INVALID_GPA_VALUES', "
        f"{big('count(*)')} FROM students WHERE gpa < 0 OR gpa > 4.0", "enrollments", "students")
    sql["job_quality_checks"] = f"SELECT check_name, {NOW_SQL} AS check_timestamp, issues_found, issues_found AS details FROM ({checks})"
    counts = ", ".join(f"(SELECT {big('count(*)')} FROM {e}) AS {e}" for e in ENTITIES)
    sql["job_reset_reload"] = _on_performance(f"SELECT {counts}, (SELECT {big('count(*)')} FROM perf) AS perf_aggregations")
    taught_now = "(SELECT count(DISTINCT course_id) FROM enrollments WHERE course_id IN (SELECT course_id FROM courses))"
    steps = {
        "student_dimension": "(SELECT count(*) FROM students WHERE enrollment_status = 'Active')", "course_dimension": "0",
        "assignment_dimension": "0", "enrollment_fact": "0", "submission_fact": "0", "activity_fact": "0",
        "student_performance_agg": "(SELECT count(*) FROM perf)", "course_analytics_agg": taught_now,
    }
    sql["job_transformations"] = _on_performance(" UNION ALL ".join(
        [f"SELECT '{n}' AS name, 'COMPLETED' AS status, {big(v)} AS records_processed" for n, v in steps.items()]
        + [f"SELECT 'no_such_step', 'UNKNOWN', {big('0')}"]))
    sql["job_triggered"] = with_ctes(
        f"SELECT DISTINCT major AS run_type, 'TRIGGERED' AS status, {NOW_SQL} AS event_at, {big('0')} AS records_processed FROM students", "students")
    sql["land_files"] = with_ctes(
        f"SELECT 'students' AS entity, 'CANVAS_LMS' AS source_system, 'PROCESSED' AS processing_status, {big('count(*)')} AS count FROM students "
        f"UNION ALL SELECT 'activity_logs', 'CANVAS_LMS', CASE WHEN {QUIZ_IDS} THEN 'ERROR' ELSE 'PROCESSED' END, {big('count(*)')} "
        "FROM activity_logs GROUP BY 3", "students", "activity_logs")
    sql["job_cost_alerts"] = with_ctes(f"{DAILY} UNION ALL {HOURLY}", "warehouse_metering")
    two_days = snap.split(" WHERE ")[0] + " WHERE snapshot_date IN (DATE '2024-01-29', DATE '2024-01-30')"
    sql["job_daily_snapshot"] = with_ctes(f"WITH {SNAPSHOTS} {two_days}", *SNAPSHOT_INPUTS)
    sql["stream_upsert_students"] = _merge("students", columns=[c for c, _ in ENTITIES["students"].columns if c != "student_key"])
    sql["job_relanded_batch"] = sql["stream_upsert_students"]
    sql["stream_rejected_rows"] = with_ctes(
        f"SELECT 'feed-' || activity_id AS raw_id, 'MALFORMED_JSON' AS reason, 'activity_logs' AS entity FROM activity_logs WHERE {QUIZ_IDS}",
        "activity_logs")
    sql["stream_changes_enrollments"] = _changes("enrollments")
    sql["job_insert_activity"] = with_ctes(
        f"WITH old AS (SELECT {fields} FROM activity_logs WHERE {STORED['activity_logs']}), "
        f"sent AS (SELECT {fields} FROM ({_resent('activity_logs')})) "
        "SELECT * FROM old UNION ALL SELECT * FROM sent WHERE activity_id NOT IN (SELECT activity_id FROM old)", "activity_logs")
    sql["job_incremental"] = _on_performance(f"SELECT {PERFORMANCE_OUT} FROM perf")
    sql["job_incremental_courses"] = sql["course_analytics"].replace(f", {NOW_SQL} AS calculated_at", "")
    sql["stream_activity_dedup"] = with_ctes(f"SELECT {fields} FROM activity_logs", "activity_logs")
    sql["stream_hourly_spike"] = with_ctes(
        "WITH w AS (SELECT * FROM warehouse_metering WHERE warehouse_name LIKE 'DEMO_%') "
        f"SELECT date_trunc('hour', start_time) AS usage_hour, warehouse_name, {dbl('sum(credits_used) * 3')} AS estimated_cost_usd FROM w GROUP BY 1, 2 "
        "HAVING sum(credits_used) * 3 > 10 AND usage_hour + INTERVAL '1' HOUR <= (SELECT max(start_time) FROM w) - INTERVAL '1' HOUR",
        "warehouse_metering")
    for state in ("open", "closed"):
        closed = "true" if state == "closed" else "usage_hour + INTERVAL '1' HOUR <= (SELECT max(start_time) FROM w) - INTERVAL '1' HOUR"
        sql[f"stream_spend_{state}"] = with_ctes(
            "WITH w AS (SELECT * FROM warehouse_metering WHERE warehouse_name LIKE 'DEMO_%') "
            f"SELECT usage_hour, warehouse_name, {dbl('usd')} AS estimated_cost_usd, usd > 10 AS spike, "
            f"CASE WHEN {closed} THEN 'CLOSED' ELSE 'OPEN' END AS state FROM (SELECT date_trunc('hour', start_time) AS usage_hour, warehouse_name, "
            "sum(credits_used) * 3 AS usd FROM w GROUP BY 1, 2)", "warehouse_metering")
    now_text = (f"CASE WHEN {AGAIN['sent']} AND {AGAIN['emptied']} THEN NULL WHEN {AGAIN['sent']} AND {AGAIN['changed']} "
                f"THEN {TEXTS['activity_logs']} || ' again' ELSE {TEXTS['activity_logs']} END")
    sql["stream_search_refresh"] = _bm25(
        f"SELECT activity_id AS doc_id, activity_type AS title, {now_text} AS txt FROM activity_logs", activity_asked, "activity_logs")
    sql["search_many_refreshes"] = sql["stream_search_refresh"]
    return sql
