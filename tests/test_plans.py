"""Physical plans: what must and must not appear in them."""

import pytest

from lectern.plans import catalog

QUERIES = catalog.queries()
EAGER = {n for n in QUERIES if n.startswith(("job_", "stream_", "search_"))}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_ranking_is_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["search_courses"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["cost_dashboard", "warehouse_daily_costs", "monthly_trends"])
def test_no_window_over_all_rows(name, spark, sf_dir):
    lines = plan_of(QUERIES[name](spark, sf_dir)).splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            assert not any("SinglePartition" in l for l in lines[i:i + 4])


def test_latest_copy_is_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["upsert_students"](spark, sf_dir))
    assert "partial_max_by" in plan and "row_number" not in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["grade_distribution"](spark, sf_dir))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_index_is_laid_out_by_one_shuffle(spark, sf_dir):
    from lectern.operators import search

    tb_rows = QUERIES["student_search_source"](spark, sf_dir)
    plan = plan_of(search.build_index(tb_rows, search.STUDENT_CORPUS).postings)
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1


def test_constraints_read_each_table_once(spark, sf_dir):
    from lectern.operators import quality
    from lectern.schemas import ENTITIES

    tables = {n: spark.createDataFrame([], e.schema) for n, e in ENTITIES.items()}
    plan = plan_of(quality.constraint_report(tables))
    assert plan.count("Scan") == len(tables) and plan.count("Exchange hashpartitioning") == 1
