import pytest

from lectern.operators import metrics


def base(spark):
    return spark.createDataFrame([("a", "X", 1.0), ("b", "X", 3.6), ("c", "Y", None)], "student_id string, major string, gpa double")


def test_unknown_names_raise(spark):
    for args in ((["total_students"], ["height"]), (["shoe_size"], ["major"])):
        with pytest.raises(KeyError):
            metrics.metric_query(base(spark), metrics.STUDENT_MODEL, *args)


def test_added_metric_and_dimension(spark):
    model = metrics.STUDENT_MODEL.with_metric("low", "count_if(gpa < 2.0)").with_dimension("initial", "substr(student_id, 1, 1)")
    got = {r.initial: r.low for r in metrics.metric_query(base(spark), model, ["low"], ["initial"]).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}
    assert "low" not in metrics.STUDENT_MODEL.metrics


def test_where_and_grand_total(spark):
    row = metrics.metric_query(base(spark), metrics.STUDENT_MODEL, ["total_students", "average_gpa"], where="major = 'X'").first()
    assert (row.total_students, row.average_gpa) == (2, 2.3)
    empty = metrics.metric_query(base(spark), metrics.STUDENT_MODEL, ["average_gpa"], where="major = 'Z'").first()
    assert empty.average_gpa is None


def test_model_sizes():
    sizes = {m.name: (len(m.dimensions), len(m.facts), len(m.metrics)) for m in metrics.MODELS.values()}
    assert sizes == {"student_analytics": (11, 1, 5), "course_analytics": (10, 2, 5), "enrollment_analytics": (15, 2, 5),
                     "submission_analytics": (12, 3, 4), "performance_dashboard": (13, 7, 5)}
