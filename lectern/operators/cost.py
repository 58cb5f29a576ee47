"""Usage metering: cost views, attribution, alerts and daily snapshots.

Every function takes its clock as ``as_of`` or ``day`` and filters the time column itself, never a
function of it, so the range reaches the scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions.scalars import at, days_before, floor_to, mean, months_before, ratio, second_boundaries
from lectern.schemas import RULES_SCHEMA

# The price per credit, the price per TB and month, the resource name pattern, the
# metered database, the alert limits in USD and the default attribution rules.
CREDIT_RATE = Decimal("3.00")
TB_MONTH_RATE = 23
NAME_PATTERN = "DEMO_%"
DATABASE = "DEMO_CANVAS_DB"
DAILY_LIMIT = Decimal("50.00")
HOURLY_LIMIT = Decimal("10.00")
DEFAULT_RULES = [
    ("WAREHOUSE", "DEMO_INGESTION_WH", "DATA_PLATFORM", "IT", "CANVAS_ETL"),
    ("WAREHOUSE", "DEMO_TRANSFORM_WH", "DATA_PLATFORM", "IT", "CANVAS_ETL"),
    ("WAREHOUSE", "DEMO_TASK_WH", "DATA_PLATFORM", "IT", "CANVAS_ETL"),
    ("CONTAINER", "CANVAS_ETL_SERVICE", "DATA_PLATFORM", "IT", "CANVAS_ETL"),
    ("COMPUTE_POOL", "DEMO_CANVAS_POOL", "DATA_PLATFORM", "IT", "CANVAS_ETL"),
]
OWNERS = ["cost_center", "department", "project"]
MB, GB, TB = 1024**2, 1024**3, 1024**4


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_RULES, RULES_SCHEMA)


def _usd(credits: Column, rate: Decimal) -> Column:
    return credits * F.lit(rate)


def _attribute(costs: DataFrame, rules: DataFrame, name: str, resource_type: str | None = None) -> DataFrame:
    """Owners by resource name, of one rule type or of any type.

    Costs come in already grouped, so the join sees one row per resource and period.
    """
    if resource_type is not None:
        rules = rules.where(F.col("resource_type") == resource_type)
    return costs.join(rules.select(F.col("resource_name").alias(name), *OWNERS), name, "left")


def usage_hourly(metering: DataFrame, *, as_of: date, days: int = 7, like: str = NAME_PATTERN,
                 rate: Decimal = CREDIT_RATE) -> DataFrame:
    duration = second_boundaries("start_time", "end_time")
    return metering.where((F.col("start_time") >= days_before(as_of, days)) & F.col("warehouse_name").like(like)).groupBy(
        floor_to("hour", "start_time").alias("usage_hour"), "warehouse_name"
    ).agg(
        F.sum("credits_used").alias("total_credits"),
        _usd(F.sum("credits_used"), rate).alias("estimated_cost_usd"),
        F.count(F.lit(1)).alias("query_count"),
        mean(F.sum(duration), F.count(duration)).alias("avg_query_duration_sec"),
    ).orderBy(F.desc("usage_hour"), "warehouse_name")


def warehouse_daily_costs(metering: DataFrame, rules: DataFrame, *, as_of: date, days: int = 30,
                          like: str = NAME_PATTERN, rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Cost per day and warehouse with its share of the day; a day without credits has no shares."""
    daily = metering.where((F.col("start_time") >= days_before(as_of, days)) & F.col("warehouse_name").like(like)).groupBy(
        F.to_date("start_time").alias("usage_date"), "warehouse_name"
    ).agg(F.sum("credits_used").alias("total_credits"))
    owned = _attribute(daily, rules, "warehouse_name", "WAREHOUSE").groupBy(
        "usage_date", "warehouse_name", *OWNERS
    ).agg(F.sum("total_credits").alias("total_credits"))
    day_total = F.sum("total_credits").over(W.partitionBy("usage_date"))
    return owned.select(
        "usage_date", "warehouse_name", *OWNERS, "total_credits",
        _usd(F.col("total_credits"), rate).alias("estimated_cost_usd"),
        ratio(F.col("total_credits"), day_total, 2, times=100).alias("pct_of_daily_spend"),
    ).orderBy(F.desc("usage_date"), F.desc("total_credits"), "warehouse_name")


def monthly_trends(metering: DataFrame, *, as_of: date, months: int = 12, like: str = NAME_PATTERN,
                   rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Monthly credits per warehouse with the change from its previous month on record."""
    monthly = metering.where(
        (F.col("start_time") >= months_before(as_of, months)) & F.col("warehouse_name").like(like)
    ).groupBy(F.to_date(floor_to("month", "start_time")).alias("usage_month"), "warehouse_name").agg(
        F.sum("credits_used").alias("total_credits")
    )
    before = F.lag("total_credits").over(W.partitionBy("warehouse_name").orderBy("usage_month"))
    with_prev = monthly.withColumn("prev_month_credits", before)
    change = F.col("total_credits") - F.col("prev_month_credits")
    return with_prev.select(
        "usage_month", "warehouse_name", "total_credits",
        _usd(F.col("total_credits"), rate).alias("estimated_cost_usd"), "prev_month_credits",
        ratio(change, F.col("prev_month_credits"), 2, times=100).alias("mom_change_pct"),
    ).orderBy(F.desc("usage_month"), "warehouse_name")


def pool_usage_hourly(pools: DataFrame, *, as_of: date, days: int = 30, like: str = NAME_PATTERN,
                      rate: Decimal = CREDIT_RATE) -> DataFrame:
    nodes = "active_node_count"
    return pools.where((F.col("start_time") >= days_before(as_of, days)) & F.col("compute_pool_name").like(like)).groupBy(
        floor_to("hour", "start_time").alias("usage_hour"), "compute_pool_name"
    ).agg(
        F.sum("credits_used").alias("total_credits"),
        _usd(F.sum("credits_used"), rate).alias("estimated_cost_usd"),
        mean(F.sum(nodes), F.count(nodes)).alias("avg_active_nodes"),
        F.max(nodes).alias("max_active_nodes"),
    ).orderBy(F.desc("usage_hour"), "compute_pool_name")


def container_daily_costs(pools: DataFrame, rules: DataFrame, *, as_of: date, days: int = 30,
                          like: str = NAME_PATTERN, rate: Decimal = CREDIT_RATE) -> DataFrame:
    sums = ["total_credits", "compute_credits", "cloud_services_credits"]
    daily = pools.where((F.col("start_time") >= days_before(as_of, days)) & F.col("compute_pool_name").like(like)).groupBy(
        F.to_date("start_time").alias("usage_date"), "compute_pool_name"
    ).agg(
        F.sum("credits_used").alias("total_credits"),
        F.sum("credits_used_compute").alias("compute_credits"),
        F.sum("credits_used_cloud_services").alias("cloud_services_credits"),
    )
    return _attribute(daily, rules, "compute_pool_name", "COMPUTE_POOL").groupBy(
        "usage_date", "compute_pool_name", *OWNERS
    ).agg(*[F.sum(c).alias(c) for c in sums]).select(
        "usage_date", "compute_pool_name", *OWNERS, "total_credits",
        _usd(F.col("total_credits"), rate).alias("estimated_cost_usd"), "compute_credits", "cloud_services_credits",
    ).orderBy(F.desc("usage_date"), "compute_pool_name")


def task_costs(tasks: DataFrame, *, as_of: date, days: int = 30, database: str = DATABASE,
               rate: Decimal = CREDIT_RATE) -> DataFrame:
    duration = second_boundaries("query_start_time", "completed_time")
    return tasks.where((F.col("query_start_time") >= days_before(as_of, days)) & (F.col("database_name") == database)).groupBy(
        F.to_date("query_start_time").alias("execution_date"), "database_name", "schema_name",
        F.col("name").alias("task_name"), "state",
    ).agg(
        F.count(F.lit(1)).alias("execution_count"),
        F.sum("credits_used").alias("total_credits"),
        _usd(F.sum("credits_used"), rate).alias("estimated_cost_usd"),
        mean(F.sum(duration), F.count(duration)).alias("avg_duration_sec"),
        F.count_if(F.col("state") == "FAILED").alias("failed_count"),
    ).orderBy(F.desc("execution_date"), F.desc("total_credits"), "task_name", "state")


def task_failures(tasks: DataFrame, *, as_of: date, days: int = 7, database: str = DATABASE) -> DataFrame:
    return tasks.where(
        (F.col("database_name") == database) & (F.col("state") == "FAILED")
        & (F.col("scheduled_time") >= days_before(as_of, days))
    ).select(
        "scheduled_time", F.col("name").alias("task_name"), "schema_name", "state", "error_code", "error_message",
        second_boundaries("query_start_time", "completed_time").alias("duration_sec"),
    ).orderBy(F.desc("scheduled_time"), "task_name")


def _in_unit(bytes_: Column, unit: int, scale: int, *, times: int = 1) -> Column:
    return F.round((bytes_ * times).cast("decimal(22,0)") / F.lit(unit).cast("decimal(14,0)"), scale)


def storage_costs(storage: DataFrame, *, as_of: date, days: int = 30, database: str = DATABASE,
                  tb_rate: int = TB_MONTH_RATE) -> DataFrame:
    live, failsafe = F.col("average_database_bytes"), F.col("average_failsafe_bytes")
    return storage.where(
        (F.col("database_name") == database) & (F.col("usage_date") >= F.date_sub(F.lit(as_of), days))
    ).select(
        "usage_date", "database_name",
        _in_unit(live, GB, 4).alias("storage_gb"),
        _in_unit(failsafe, GB, 4).alias("failsafe_gb"),
        _in_unit(live + failsafe, TB, 4).alias("total_tb"),
        _in_unit(live + failsafe, TB, 2, times=tb_rate).alias("estimated_monthly_cost_usd"),
    ).orderBy(F.desc("usage_date"))


def table_storage(tables: DataFrame, *, database: str = DATABASE) -> DataFrame:
    """Sizes of live tables; a table without rows has no bytes per row."""
    active, travel, failsafe = F.col("active_bytes"), F.col("time_travel_bytes"), F.col("failsafe_bytes")
    per_row = active.cast("decimal(22,0)") / F.nullif(F.col("row_count").cast("decimal(14,0)"), F.lit(0))
    return tables.where((F.col("table_catalog") == database) & F.col("deleted").isNull()).select(
        F.col("table_catalog").alias("database_name"), "table_schema", "table_name",
        _in_unit(active, MB, 2).alias("active_mb"),
        _in_unit(travel, MB, 2).alias("time_travel_mb"),
        _in_unit(failsafe, MB, 2).alias("failsafe_mb"),
        _in_unit(active + travel + failsafe, MB, 2).alias("total_mb"),
        "row_count",
        F.round(per_row, 2).alias("bytes_per_row"),
    )


def top_tables(tables: DataFrame, n: int = 20, *, database: str = DATABASE) -> DataFrame:
    return table_storage(tables, database=database).orderBy(F.desc("total_mb"), "table_name").limit(n)


def cost_dashboard(metering: DataFrame, pools: DataFrame, tasks: DataFrame, rules: DataFrame, *, as_of: date,
                   days: int = 30, like: str = NAME_PATTERN, database: str = DATABASE,
                   rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Credits of warehouses, pools and tasks with owners and the share of the grand total.

    A resource named by several rules appears once per rule, and its copies count in the total.
    """
    since = days_before(as_of, days)

    def total(df: DataFrame, kind: str, name: str) -> DataFrame:
        return df.groupBy(F.col(name).alias("resource_name")).agg(
            F.sum("credits_used").cast("decimal(38,2)").alias("total_credits")
        ).select(F.lit(kind).alias("resource_type"), "resource_name", "total_credits")

    costs = total(
        metering.where((F.col("start_time") >= since) & F.col("warehouse_name").like(like)), "WAREHOUSE", "warehouse_name"
    ).unionByName(total(
        pools.where((F.col("start_time") >= since) & F.col("compute_pool_name").like(like)), "CONTAINER", "compute_pool_name"
    )).unionByName(total(
        tasks.where((F.col("query_start_time") >= since) & (F.col("database_name") == database)), "TASK", "name"
    ))
    owned = _attribute(costs, rules, "resource_name")
    grand = owned.agg(F.sum("total_credits")).scalar()
    return owned.select(
        "resource_type", "resource_name", *OWNERS, "total_credits",
        F.round(_usd(F.col("total_credits"), rate), 2).alias("estimated_cost_usd"),
        ratio(F.col("total_credits"), grand, 2, times=100).alias("pct_of_total"),
    ).orderBy(F.desc("total_credits"), "resource_name")


def _alerts(metering: DataFrame, *, since: Column, alert_type: str, period: Column, limit: Decimal, text: str,
            like: str, rate: Decimal, now: datetime) -> DataFrame:
    usd = F.round(F.col("usd"), 2)
    return metering.where((F.col("start_time") >= since) & F.col("warehouse_name").like(like)).groupBy(
        "warehouse_name"
    ).agg(_usd(F.sum("credits_used"), rate).alias("usd")).where(F.col("usd") > F.lit(limit)).select(
        F.lit(alert_type).alias("alert_type"), F.lit("WAREHOUSE").alias("resource_type"),
        F.col("warehouse_name").alias("resource_name"), period.alias("period"),
        F.lit(limit).cast("decimal(15,2)").alias("threshold_value"),
        usd.cast("decimal(15,2)").alias("current_value"),
        F.concat(F.lit(text), F.col("warehouse_name"), F.lit(": $"), usd.cast("decimal(15,2)").cast("string")).alias("alert_message"),
        at(now).alias("alert_timestamp"), F.lit(False).alias("acknowledged"),
        F.lit(None).cast("string").alias("acknowledged_by"),
        F.lit(None).cast("timestamp_ntz").alias("acknowledged_at"),
    )


def alert_daily_threshold(metering: DataFrame, *, now: datetime, limit: Decimal = DAILY_LIMIT,
                          like: str = NAME_PATTERN, rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Warehouses whose cost since midnight is over the limit."""
    midnight = datetime(now.year, now.month, now.day)
    return _alerts(metering, since=at(midnight), alert_type="DAILY_THRESHOLD_EXCEEDED", period=at(midnight),
                   limit=limit, text="Daily cost threshold exceeded for warehouse ", like=like, rate=rate, now=now)


def alert_hourly_spike(metering: DataFrame, *, now: datetime, limit: Decimal = HOURLY_LIMIT,
                       like: str = NAME_PATTERN, rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Warehouses whose cost in the last hour is over the limit."""
    hour = now.replace(minute=0, second=0, microsecond=0)
    return _alerts(metering, since=at(now - timedelta(hours=1)), alert_type="HOURLY_SPIKE", period=at(hour),
                   limit=limit, text="Unusual hourly cost spike for warehouse ", like=like, rate=rate, now=now)


def cost_alerts(metering: DataFrame, *, now: datetime, daily: Decimal = DAILY_LIMIT, hourly: Decimal = HOURLY_LIMIT,
                like: str = NAME_PATTERN, rate: Decimal = CREDIT_RATE) -> DataFrame:
    return alert_daily_threshold(metering, now=now, limit=daily, like=like, rate=rate).unionByName(
        alert_hourly_spike(metering, now=now, limit=hourly, like=like, rate=rate)
    )


def new_alerts(alerts: DataFrame, logged: DataFrame) -> DataFrame:
    """Alerts not logged yet for the same resource and period, so a rerun adds nothing."""
    return alerts.join(logged, ["alert_type", "resource_name", "period"], "left_anti").select(alerts.columns)


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(~F.col("acknowledged")).orderBy(F.desc("alert_timestamp"), "alert_type", "resource_name")


def _snapshot(usage: DataFrame, rules: DataFrame, kind: str, name: str, *, day: date, like: str,
              rate: Decimal) -> DataFrame:
    start = at(datetime(day.year, day.month, day.day))
    end = at(datetime(day.year, day.month, day.day) + timedelta(days=1))
    used = usage.where((F.col("start_time") >= start) & (F.col("start_time") < end) & F.col(name).like(like)).groupBy(
        F.col(name).alias("resource_name")
    ).agg(F.sum("credits_used").alias("credits_used"))
    return _attribute(used, rules, "resource_name").groupBy("resource_name", *OWNERS).agg(
        F.sum("credits_used").alias("credits_used")
    ).select(
        F.lit(day).alias("snapshot_date"), F.lit(kind).alias("resource_type"), "resource_name",
        F.col("credits_used").cast("decimal(20,10)").alias("credits_used"),
        _usd(F.col("credits_used"), rate).cast("decimal(15,2)").alias("estimated_cost_usd"), *OWNERS,
    )


def snapshot_warehouse(metering: DataFrame, rules: DataFrame, *, day: date, like: str = NAME_PATTERN,
                       rate: Decimal = CREDIT_RATE) -> DataFrame:
    """One day's warehouse cost; rules of every type match by name."""
    return _snapshot(metering, rules, "WAREHOUSE", "warehouse_name", day=day, like=like, rate=rate)


def snapshot_container(pools: DataFrame, rules: DataFrame, *, day: date, like: str = NAME_PATTERN,
                       rate: Decimal = CREDIT_RATE) -> DataFrame:
    return _snapshot(pools, rules, "CONTAINER", "compute_pool_name", day=day, like=like, rate=rate)


def daily_snapshot(metering: DataFrame, pools: DataFrame, rules: DataFrame, *, day: date) -> DataFrame:
    """Both snapshots of one day; store them with the day's partition overwritten."""
    return snapshot_warehouse(metering, rules, day=day).unionByName(snapshot_container(pools, rules, day=day))


def snapshots_from_usage(metering: DataFrame, pools: DataFrame, rules: DataFrame, *, like: str = NAME_PATTERN,
                         rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Every day's snapshot in one pass, to build the history at once."""
    def days(usage: DataFrame, kind: str, name: str) -> DataFrame:
        used = usage.where(F.col(name).like(like)).groupBy(
            F.to_date("start_time").alias("snapshot_date"), F.col(name).alias("resource_name")
        ).agg(F.sum("credits_used").alias("credits_used"))
        return _attribute(used, rules, "resource_name").select(
            "snapshot_date", F.lit(kind).alias("resource_type"), "resource_name",
            F.col("credits_used").cast("decimal(20,10)").alias("credits_used"),
            _usd(F.col("credits_used"), rate).cast("decimal(15,2)").alias("estimated_cost_usd"), *OWNERS,
        )
    return days(metering, "WAREHOUSE", "warehouse_name").unionByName(days(pools, "CONTAINER", "compute_pool_name"))


def cost_summary(snapshots: DataFrame, *, as_of: date, days: int = 7) -> DataFrame:
    return snapshots.where(F.col("snapshot_date") >= F.date_sub(F.lit(as_of), days)).groupBy(
        "resource_type", "resource_name"
    ).agg(
        F.round(F.sum("credits_used"), 4).alias("total_credits"),
        F.round(F.sum("estimated_cost_usd"), 2).alias("total_cost_usd"),
    ).orderBy(F.desc("total_cost_usd"), "resource_name")


def cost_by_project(snapshots: DataFrame, *, as_of: date, days: int = 30) -> DataFrame:
    return snapshots.where(F.col("snapshot_date") >= F.date_sub(F.lit(as_of), days)).groupBy("project", "department").agg(
        F.round(F.sum("credits_used"), 4).alias("total_credits"),
        F.round(F.sum("estimated_cost_usd"), 2).alias("total_cost_usd"),
        F.countDistinct("resource_name").alias("resource_count"),
    ).orderBy(F.desc("total_cost_usd"), "project")


def service_metrics(serverless: DataFrame, *, database: str = DATABASE) -> DataFrame:
    return serverless.where(F.col("database_name") == database).select(
        "start_time", "end_time", "credits_used", "credits_used_cloud_services", "credits_used_compute"
    ).orderBy(F.desc("start_time"))
