"""One key holds a third of all rows: results stay whole and the hot key never travels row by row."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lectern.operators import aggregates, quality, upsert

NOW = datetime(2024, 2, 1)
ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    student = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string")))
    return spark.range(ROWS).select(
        "id", student.alias("student_id"), F.lit("c0").alias("course_id"),
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("enrollment_id"),
        F.lit("active").alias("enrollment_state"), F.lit("A").alias("final_grade"),
        (50 + F.col("id") % 50).cast("decimal(5,2)").alias("final_score"),
        (F.col("id") % 100).alias("duration_seconds"), F.lit(NOW).cast("timestamp_ntz").alias("activity_timestamp"),
    )


def shuffled_rows(df) -> list[int]:
    """Rows written by each shuffle of the finished plan."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_latest_copy_of_a_hot_key(spark, hot):
    source = hot.select(F.col("student_id").alias("k"), "id", F.col("activity_timestamp").alias("ingested_at"),
                        F.lpad(F.col("id").cast("string"), 9, "0").alias("raw_id"))
    last = upsert.latest_per_key(source, ["k"])
    assert {r.k: r.id for r in last.where("k = 'hot'").collect()} == {"hot": ROWS - 3}
    # Each map task hands over one row per key it holds, not one per copy.
    assert max(shuffled_rows(last)) <= 501 * spark.sparkContext.defaultParallelism


def test_engagement_and_course_rollup(spark, hot):
    assert max(shuffled_rows(aggregates.engagement_minutes(hot))) <= 501 * spark.sparkContext.defaultParallelism
    courses = spark.createDataFrame([("c0", "T")], "course_id string, term string")
    row = aggregates.course_analytics(courses, hot, hot, now=NOW).first()
    assert row.total_enrolled == row.active_students == hot.select("student_id").distinct().count()
    assert row.grade_distribution.A == ROWS and row.median_class_score == hot.agg(F.median("final_score")).first()[0]


def test_orphans_of_a_hot_foreign_key(spark, hot):
    dims = spark.createDataFrame([("s1",)], "student_id string")
    report = quality.constraint_report({"students": dims, "enrollments": hot})
    got = {(r.constraint_type, r.column_name): r.violations for r in report.collect()}
    assert got["FOREIGN_KEY", "student_key"] == hot.where("student_id <> 's1'").count()
