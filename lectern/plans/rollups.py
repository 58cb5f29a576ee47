"""Rollups that follow the change logs of the curated tables.

State tables hold signed partial sums and counts: what a batch adds, less what it takes away, so that rows of one group are added up in any
order. A batch appends its own sums; folders of sums are merged level by level. What cannot be undone by subtracting is kept as counts: the
scores of a course as (score, count), the days of activity as (day, count), the rows of each student in a course, and of each student and
assignment. Submissions whose assignment is not there yet wait in their own sums, and count from the batch that brings it.

A refresh takes the changes since its last one, finds the groups they touch, and computes only these from the state, in the same expressions as
the rollups over whole tables. State and results lie in buckets by course (submissions by assignment), and only touched buckets are
read and rewritten. Each state table notes the commit that it includes in the same list that makes its sums count, and a result
moves on when its rows are stored; a refresh that is repeated after a crash so adds nothing twice and forgets no group.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.scalars import half_up_minutes
from lectern.operators import aggregates
from lectern.operators.aggregates import PAIR
from lectern.plans import jobs
from lectern.schemas import COURSE_ANALYTICS_SCHEMA, ENTITIES, GRADE_BANDS, PERFORMANCE_SCHEMA
from lectern.session import scratch_dir
from lectern.sources.changes import Consumer, sign
from lectern.sources.segments import Segments
from lectern.sources.store import Lake

AT_RISK_BELOW = 60
#: Rows of a fact that one bucket is meant for.
ROWS_PER_BUCKET = 20_000_000


@dataclass(frozen=True)
class State:
    """Signed sums of the changes of one entity. ``sums`` are SQL expressions of one row, summed with the sign of its change."""

    name: str
    entity: str
    keys: dict[str, str]
    sums: dict[str, tuple[str, str]]
    bucket_by: str
    where: str = "true"

    @property
    def schema(self) -> str:
        columns = [f"{k} {t}" for k, (t, _) in self.keys_types()] + [f"{c} {t}" for c, (t, _) in self.sums.items()]
        return ", ".join([*columns, "bucket int"])

    def keys_types(self) -> list[tuple[str, tuple[str, str]]]:
        return [(k, tuple(t.split(" AS ", 1)) if " AS " in t else (t, k)) for k, t in self.keys.items()]

    def of_changes(self, rows: DataFrame) -> DataFrame:
        """Sums of logged rows (with ``change``); groups in which all cancel out are left out."""
        keys = [F.expr(e).alias(k) for k, (_, e) in self.keys_types()]
        values = {c: F.expr(f"CAST({e} AS {t})") for c, (t, e) in self.sums.items()}
        signed = rows.where(self.where).select(*keys, *[(v * sign()).alias(c) for c, v in values.items()])
        return self.added(signed)

    def added(self, rows: DataFrame) -> DataFrame:
        out = rows.groupBy(*self.keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, (t, _) in self.sums.items()])
        some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in self.sums])
        return out.where(some)


def _flag(condition: str) -> tuple[str, str]:
    return "bigint", f"CASE WHEN {condition} THEN 1 ELSE 0 END"


GRADES = State("grades", "enrollments", {"student_id": "string", "course_id": "string", "final_grade": "string"}, {"n": ("bigint", "1")}, "course_id")
SCORES = State("scores", "enrollments", {"course_id": "string", "final_score": "decimal(5,2)"}, {"n": ("bigint", "1")}, "course_id",
               "final_score IS NOT NULL")
MEMBERS = State(
    "members", "enrollments", {"student_id": "string", "course_id": "string"},
    {
        "rows": ("bigint", "1"), "active_rows": _flag("enrollment_state = 'active'"), "completed": _flag("enrollment_state = 'completed'"),
        "score_sum": ("decimal(20,2)", "coalesce(final_score, 0)"), "score_n": _flag("final_score IS NOT NULL"),
        "at_risk": _flag(f"final_score < {AT_RISK_BELOW}"),
        **{f"grade_{b}": _flag("final_grade IN ({})".format(", ".join(f"'{g}'" for g in grades))) for b, grades in GRADE_BANDS.items()},
    }, "course_id")
MARKS = State(
    "marks", "submissions", {"student_id": "string", "assignment_id": "string"},
    {
        "rows": ("bigint", "1"), "completed": _flag("submission_id IS NOT NULL"),
        "pct_sum": ("decimal(20,2)", "coalesce(percentage, 0)"), "pct_n": _flag("percentage IS NOT NULL"),
        "earned": ("decimal(20,2)", "coalesce(score, 0)"), "earned_n": _flag("score IS NOT NULL"),
        "possible": ("decimal(20,2)", "coalesce(points_possible, 0)"), "possible_n": _flag("points_possible IS NOT NULL"),
        "late": _flag("late_flag"), "missing": _flag("missing_flag"),
    }, "assignment_id")
DAYS = State(
    "days", "activity_logs", {"student_id": "string", "course_id": "string", "day": "date AS CAST(activity_timestamp AS DATE)"},
    {"n": ("bigint", "1"), "seconds": ("bigint", "coalesce(duration_seconds, 0)"), "seconds_n": _flag("duration_seconds IS NOT NULL")}, "course_id")
STATES = (GRADES, SCORES, MEMBERS, MARKS, DAYS)


class Rollups:
    """The rollups of one lake. ``buckets`` counts when the state is first built; by default it follows the number of rows."""

    def __init__(self, lake: Lake, *, buckets: int | None = None, fan: int = 4):
        self.lake, self.fan = lake, fan
        self.held = {s.name: Segments(lake, f"rollup/{s.name}", fan=fan) for s in STATES}
        self.buckets = self.held[GRADES.name].info().get("buckets", buckets)
        self.logs = {ENTITIES[e].table: jobs.change_log(lake, e) for e in ENTITIES}

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    # state

    def follow(self) -> None:
        """Bring every state table up to the newest commit; one that is missing is built from its fact."""
        for entity in ENTITIES:
            jobs.recover(self.lake, entity)
        if self.buckets is None:
            rows = max(jobs.curated(self.lake, s.entity).count() for s in (GRADES, MARKS, DAYS))
            self.buckets = max(1, rows // ROWS_PER_BUCKET)
        for state in STATES:
            held, log = self.held[state.name], self.logs[ENTITIES[state.entity].table]
            upto = log.last()
            if not held.exists():
                rows = jobs.curated(self.lake, state.entity).withColumn("change", F.lit("insert"))
            elif held.info()["upto"] < upto:
                rows = log.read(held.info()["upto"], upto)
            else:
                continue
            sums = state.of_changes(rows).withColumn("bucket", self._bucket(state.bucket_by)).hint("rebalance", "bucket")
            held.add(sums, f"upto-{upto}", "bucket", info={"upto": upto, "buckets": self.buckets})
            held.merge(state.schema, lambda df, s=state: s.added(df).withColumn("bucket", self._bucket(s.bucket_by)).hint("rebalance", "bucket"), "bucket")

    def rows(self, state: State, buckets: list[int] | None = None) -> DataFrame:
        """The added-up sums of a state table, from some buckets only."""
        held = self.held[state.name]
        rows = held.read(state.schema, values=buckets)
        # A single folder was added up when it was written.
        return rows.select(*state.keys, *state.sums) if len(held.live()) == 1 else state.added(rows)

    # what a span of commits touches

    def _news(self, entity: str, spans: dict[str, tuple[int, int]], *columns: str) -> DataFrame:
        """Distinct values of columns whose number of rows changed within the span."""
        table = ENTITIES[entity].table
        rows = self.logs[table].read(*spans.get(table, (0, 0))) if table in spans else self.logs[table].read(0, 0)
        return rows.groupBy(*columns).agg(F.sum(sign()).alias("n")).where("n <> 0").drop("n")

    def _delta(self, state: State, spans: dict[str, tuple[int, int]]) -> DataFrame:
        table = ENTITIES[state.entity].table
        return state.of_changes(self.logs[table].read(*spans.get(table, (0, 0))))

    def _changed_courses(self, spans: dict[str, tuple[int, int]]) -> DataFrame:
        """Courses that came, went or moved to another term, or got or lost assignments."""
        offered = self._news("courses", spans, "course_id", "term").select("course_id")
        return offered.unionByName(self._news("assignments", spans, "assignment_id", "course_id").select("course_id")).distinct()

    def touched_pairs(self, spans: dict[str, tuple[int, int]]) -> DataFrame:
        """Students and courses whose performance may differ after the span."""
        assignments = jobs.curated(self.lake, "assignments").select("assignment_id", "course_id")
        found = [self._delta(s, spans).select(*PAIR) for s in (GRADES, DAYS)]
        found.append(self._delta(MARKS, spans).join(assignments, "assignment_id").select(*PAIR))
        courses, students = self._changed_courses(spans), self._news("students", spans, "student_id")
        if not courses.isEmpty():
            buckets = [r[0] for r in courses.select(self._bucket("course_id")).distinct().collect()]
            found.append(self.rows(GRADES, buckets).select(*PAIR).join(courses, "course_id", "left_semi"))
        if not students.isEmpty():
            found.append(self.rows(GRADES).select(*PAIR).join(students, "student_id", "left_semi"))
        every = reduce(DataFrame.unionByName, found)
        return every.where("student_id IS NOT NULL AND course_id IS NOT NULL").distinct()

    def touched_courses(self, spans: dict[str, tuple[int, int]]) -> DataFrame:
        """Courses whose analytics may differ after the span."""
        direct = [self._delta(s, spans).select("course_id") for s in (MEMBERS, SCORES, DAYS)]
        every = reduce(DataFrame.unionByName, [*direct, self._news("courses", spans, "course_id", "term").select("course_id")])
        return every.where("course_id IS NOT NULL").distinct()

    # the rollups of some groups

    def performance_of(self, pairs: DataFrame | None, buckets: list[int] | None, *, now: datetime, compat: bool = False) -> DataFrame:
        """Performance rows of some students and courses, or of all."""
        assignments = jobs.curated(self.lake, "assignments").select("assignment_id", "course_id")
        offered = aggregates.offered_courses(jobs.curated(self.lake, "courses"), assignments)
        given = " AND ".join(f"{c} IS NOT NULL" for c in PAIR)
        wanted = lambda df: df.where(given) if pairs is None else df.join(pairs, PAIR, "left_semi")
        group = (
            wanted(self.rows(GRADES, buckets).where("n > 0"))
            .join(jobs.curated(self.lake, "students").select("student_id"), "student_id", "left_semi")
            .join(offered, "course_id").withColumnRenamed("n", "n_enrolled")
        )
        some = lambda total, n: F.when(F.sum(n) > 0, F.sum(total))
        # The sums of a pair are those of its course's assignments.
        inside = None if pairs is None or buckets is None else [
            r[0] for r in assignments.join(pairs.select("course_id").distinct(), "course_id").select(self._bucket("assignment_id")).distinct().collect()]
        marks = wanted(self.rows(MARKS, inside).where("rows > 0").join(assignments, "assignment_id")).groupBy(*PAIR).agg(
            F.sum("completed").alias("completed"), F.sum("pct_sum").alias("pct_sum"), F.sum("pct_n").alias("pct_n"),
            some("earned", "earned_n").alias("earned"), some("possible", "possible_n").alias("possible"), F.sum("late").alias("late"),
            F.sum("missing").alias("missing"), F.count(F.lit(1)).alias("submitted_assignments"), F.sum("rows").alias("rows"))
        days = wanted(self.rows(DAYS, buckets).where("n > 0")).groupBy(*PAIR).agg(
            some("seconds", "seconds_n").alias("seconds"), F.sum("n").alias("n_activity"), F.max("day").alias("last_activity"))
        joined = group.join(marks, PAIR, "left").join(days, PAIR, "left")
        return aggregates.performance_rows(joined, now=now, compat=compat)

    def analytics_of(self, courses: DataFrame | None, buckets: list[int] | None, *, now: datetime) -> DataFrame:
        """Analytics of some courses, or of all."""
        mine = lambda state: (lambda df: df.where("course_id IS NOT NULL") if courses is None else df.join(courses, "course_id", "left_semi"))(
            self.rows(state, buckets))
        minutes = mine(DAYS).where("n > 0").groupBy(*PAIR).agg(
            half_up_minutes(F.when(F.sum("seconds_n") > 0, F.sum("seconds"))).alias("total_minutes"))
        scored = F.when(F.col("score_n") > 0, F.col("score_sum")).alias("score_sum")
        members = mine(MEMBERS).where("rows > 0").select(
            *PAIR, "rows", (F.col("active_rows") > 0).alias("active"), scored, "score_n", "completed", "at_risk", *[f"grade_{b}" for b in GRADE_BANDS])
        pair = members.join(minutes, PAIR, "left")
        return aggregates.course_rows(jobs.curated(self.lake, "courses"), pair, exact_medians(mine(SCORES).where("n > 0")), now=now)

    # results

    def _replace(self, table: str, groups: DataFrame, keys: list[str], new, schema: str) -> int:
        """Replace the rows of ``groups`` in a bucketed result by what ``new`` makes of them; returns the number of new rows."""
        path = scratch_dir(self.lake.spark, "touched")
        groups = groups.withColumn("bucket", self._bucket("course_id"))
        groups.write.parquet(path)
        stored = self.lake.spark.read.schema(groups.schema).parquet(path)
        # At most one number per bucket.
        buckets = [r[0] for r in stored.select("bucket").distinct().collect()]
        if not buckets:
            return 0
        rows = new(stored.drop("bucket"), buckets).withColumn("bucket", self._bucket("course_id"))
        made = f"{path}-rows"
        rows.write.parquet(made)
        rows = self.lake.spark.read.schema(f"{schema}, bucket int").parquet(made)
        held = {int(b) for b in self.lake.partitions(table, "bucket")}
        old = self.lake.read(table, f"{schema}, bucket int", [b for b in buckets if b in held], "bucket")
        kept = old.join(stored.select(*keys), keys, "left_anti").select(*rows.columns).unionByName(rows)
        left = {r[0] for r in kept.select("bucket").distinct().collect()}
        self.lake.replace_partitions(table, kept.hint("rebalance", "bucket"), "bucket")
        for b in (set(buckets) & held) - left:
            self.lake.drop_partition(table, f"bucket={b}")
        return rows.count()

    def _refresh(self, name: str, table: str, entities: tuple[str, ...], touched, keys: list[str], new, whole, schema: str) -> int:
        self.follow()
        reader, tables = Consumer(self.lake, name), [ENTITIES[e].table for e in entities]
        ends = {t: self.logs[t].last() for t in tables}
        if not self.lake.partitions(table, "bucket"):
            # There is no result yet, or one that was computed as a whole.
            self.lake.replace(table, whole().withColumn("bucket", self._bucket("course_id")).hint("rebalance", "bucket"), "bucket")
            records = self.lake.read(table, schema).count()
        else:
            spans = {t: (reader.position(t), end) for t, end in ends.items() if end > reader.position(t)}
            records = self._replace(table, touched(spans), keys, new, schema) if spans else 0
        for t, end in ends.items():
            reader.move(t, end)
        return records

    def refresh_performance(self, *, now: datetime) -> int:
        """Bring the performance rollup up to date; returns the number of rows that were computed."""
        return self._refresh(
            "performance", f"curated/{jobs.PERFORMANCE}", tuple(ENTITIES), self.touched_pairs, PAIR,
            lambda pairs, buckets: self.performance_of(pairs, buckets, now=now), lambda: self.performance_of(None, None, now=now), PERFORMANCE_SCHEMA)

    def refresh_analytics(self, *, now: datetime) -> int:
        return self._refresh(
            "analytics", f"curated/{jobs.ANALYTICS}", ("courses", "enrollments", "activity_logs"), self.touched_courses, ["course_id"],
            lambda courses, buckets: self.analytics_of(courses, buckets, now=now), lambda: self.analytics_of(None, None, now=now), COURSE_ANALYTICS_SCHEMA)


def exact_medians(scores: DataFrame) -> DataFrame:
    """The median of each course from (course, score, n), found where the counts before a score pass the middle."""
    order = W.partitionBy("course_id").orderBy("final_score")
    upto, every = F.sum("n").over(order), F.sum("n").over(W.partitionBy("course_id"))
    counted = scores.withColumns({"upto": upto, "every": every})
    holds = lambda place: F.max(F.when((F.col("upto") - F.col("n") < place) & (place <= F.col("upto")), F.col("final_score")))
    low, high = F.floor((F.col("every") + 1) / 2), F.floor(F.col("every") / 2) + 1
    return counted.groupBy("course_id").agg(((holds(low) + holds(high)) / 2).alias("median"))
