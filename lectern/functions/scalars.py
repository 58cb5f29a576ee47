"""Column helpers shared by the operators. All of them stay JVM-side."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(value: date | datetime) -> Column:
    """A zone-free timestamp literal; operators take their clock as an argument."""
    return F.lit(value).cast("timestamp_ntz")


def days_before(as_of: date | datetime, days: int) -> Column:
    return F.expr(f"CAST(DATE'{as_of:%Y-%m-%d}' - INTERVAL '{days}' DAY AS TIMESTAMP_NTZ)")


def months_before(as_of: date | datetime, months: int) -> Column:
    return F.add_months(F.lit(as_of).cast("date"), -months).cast("timestamp_ntz")


def floor_to(unit: str, ts: str | Column) -> Column:
    return F.date_trunc(unit, F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def second_boundaries(start: str, end: str) -> Column:
    """Seconds between two times, counted as boundaries crossed, not as elapsed whole seconds."""
    whole = lambda c: F.unix_seconds(F.date_trunc("second", F.col(c)).cast("timestamp"))
    return whole(end) - whole(start)


def ratio(num: Column, den: Column, scale: int, *, times: int = 1) -> Column:
    """``num * times / den`` rounded half up in decimal; NULL when the denominator is 0.

    The operand types leave 16 fractional digits in the quotient, so it is rounded only once.
    """
    quotient = (num * F.lit(times)).cast("decimal(22,4)") / F.nullif(den.cast("decimal(20,4)"), F.lit(0))
    return F.round(quotient, scale)


def mean(total: Column, count: Column) -> Column:
    """Unrounded mean of a decimal or integer sum as a double; NULL for an empty group."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def academic_standing(gpa: Column) -> Column:
    return (
        F.when(gpa >= 3.5, "Deans List").when(gpa >= 3.0, "Good Standing")
        .when(gpa >= 2.0, "Satisfactory").otherwise("Academic Probation")
    )


def grade_points(score: Column) -> Column:
    point = lambda v: F.lit(v).cast("decimal(2,1)")
    return (
        F.when(score >= 90, point("4.0")).when(score >= 80, point("3.0")).when(score >= 70, point("2.0"))
        .when(score >= 60, point("1.0")).when(score.isNotNull(), point("0.0"))
    )


def grade_category(score: Column) -> Column:
    return (
        F.when(score >= 90, "Excellent").when(score >= 80, "Good").when(score >= 70, "Satisfactory")
        .when(score >= 60, "Poor").when(score.isNotNull(), "Failing").otherwise("Not Graded")
    )


def score_category(percentage: Column) -> Column:
    return (
        F.when(percentage >= 90, "Excellent").when(percentage >= 80, "Good").when(percentage >= 70, "Satisfactory")
        .when(percentage >= 60, "Below Average").otherwise("Failing")
    )


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """NULL when either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def half_up_minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60)).cast("bigint")
