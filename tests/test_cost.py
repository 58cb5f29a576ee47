from datetime import date, datetime
from decimal import Decimal

from lectern.operators import cost
from lectern.schemas import RULES_SCHEMA

USAGE = "start_time timestamp_ntz, end_time timestamp_ntz, warehouse_name string, credits_used decimal(12,2)"
AS_OF = date(2024, 1, 31)


def usage(spark, *rows):
    return spark.createDataFrame([(datetime(2024, 1, d, h), datetime(2024, 1, d, h, 0, 30), w, Decimal(c)) for d, h, w, c in rows], USAGE)


def rules(spark, *rows):
    return spark.createDataFrame([(t, n, "CC", "IT", p) for t, n, p in rows], RULES_SCHEMA)


def test_shares_sum_to_100_and_a_day_without_credits_has_none(spark):
    df = usage(spark, (30, 1, "DEMO_A", "1"), (30, 2, "DEMO_B", "2"), (29, 1, "DEMO_A", "0"), (30, 1, "OTHER", "50"))
    rows = cost.warehouse_daily_costs(df, rules(spark, ("WAREHOUSE", "DEMO_A", "P")), as_of=AS_OF).collect()
    by = {(str(r.usage_date), r.warehouse_name): r for r in rows}
    assert by["2024-01-30", "DEMO_A"].pct_of_daily_spend == Decimal("33.33")
    assert by["2024-01-30", "DEMO_A"].pct_of_daily_spend + by["2024-01-30", "DEMO_B"].pct_of_daily_spend == 100
    assert by["2024-01-29", "DEMO_A"].pct_of_daily_spend is None
    assert by["2024-01-30", "DEMO_A"].project == "P" and by["2024-01-30", "DEMO_B"].project is None


def test_rules_by_type_and_by_name_only(spark):
    df = usage(spark, (30, 1, "DEMO_A", "1"))
    other = rules(spark, ("COMPUTE_POOL", "DEMO_A", "P"))
    assert cost.warehouse_daily_costs(df, other, as_of=AS_OF).first().project is None
    assert cost.snapshot_warehouse(df, other, day=date(2024, 1, 30)).first().project == "P"


def test_two_rules_for_one_name_give_two_dashboard_rows(spark):
    df = usage(spark, (30, 1, "DEMO_A", "1"))
    pools = spark.createDataFrame([], "start_time timestamp_ntz, compute_pool_name string, credits_used decimal(12,2)")
    tasks = spark.createDataFrame([], "query_start_time timestamp_ntz, database_name string, name string, credits_used decimal(12,2)")
    both = rules(spark, ("WAREHOUSE", "DEMO_A", "P"), ("CONTAINER", "DEMO_A", "Q"))
    rows = cost.cost_dashboard(df, pools, tasks, both, as_of=AS_OF).collect()
    assert {(r.project, r.pct_of_total) for r in rows} == {("P", Decimal("50.00")), ("Q", Decimal("50.00"))}


def test_month_over_month(spark):
    rows = [(datetime(2023, m, 2), datetime(2023, m, 2), "DEMO_A", Decimal(c)) for m, c in ((10, "0"), (11, "3"), (12, "2"))]
    got = {r.usage_month.month: r.mom_change_pct for r in
           cost.monthly_trends(spark.createDataFrame(rows, USAGE), as_of=AS_OF).collect()}
    assert got == {10: None, 11: None, 12: Decimal("-33.33")}


def test_alerts_are_logged_once(spark):
    df = usage(spark, (30, 23, "DEMO_A", "20"), (30, 1, "DEMO_B", "16.67"))
    now = datetime(2024, 1, 30, 23, 30)
    alerts = cost.cost_alerts(df, now=now)
    got = {(r.alert_type, r.resource_name): r.alert_message for r in alerts.collect()}
    assert set(got) == {("DAILY_THRESHOLD_EXCEEDED", "DEMO_A"), ("DAILY_THRESHOLD_EXCEEDED", "DEMO_B"), ("HOURLY_SPIKE", "DEMO_A")}
    assert got["HOURLY_SPIKE", "DEMO_A"] == "Unusual hourly cost spike for warehouse DEMO_A: $60.00"
    assert cost.new_alerts(alerts, alerts).count() == 0


def test_storage_units_and_empty_tables(spark):
    df = spark.createDataFrame([("DEMO_CANVAS_DB", "S", "T", 1048576 * 3, 0, 0, 0, None), ("DEMO_CANVAS_DB", "S", "U", 10, 0, 0, 4, None),
                                ("DEMO_CANVAS_DB", "S", "V", 10, 0, 0, 4, date(2024, 1, 1))],
                               "table_catalog string, table_schema string, table_name string, active_bytes bigint, "
                               "time_travel_bytes bigint, failsafe_bytes bigint, row_count bigint, deleted date")
    got = {r.table_name: (r.active_mb, r.bytes_per_row) for r in cost.table_storage(df).collect()}
    assert got["T"] == (Decimal("3.00"), None) and got["U"][1] == Decimal("2.50") and "V" not in got


def test_seconds_count_boundaries(spark):
    from lectern.functions.scalars import second_boundaries
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(second_boundaries("a", "b")).first()[0] == 1


def test_time_range_reaches_the_scan(spark, tmp_path):
    usage(spark, (30, 1, "DEMO_A", "1")).write.parquet(str(tmp_path / "u"))
    plan = cost.usage_hourly(spark.read.parquet(str(tmp_path / "u")), as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_time" in plan[plan.index("PushedFilters"):]
