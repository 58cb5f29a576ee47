"""Run log as append-only events, and what is read from it."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.schemas import RUN_EVENT_SCHEMA

OPEN = ("STARTED", "TRIGGERED")


def run_event(spark: SparkSession, run_id: str, run_type: str, status: str, *, now: datetime,
              records_processed: int = 0, error_message: str | None = None,
              metadata: Mapping | None = None) -> DataFrame:
    """One event row: TRIGGERED, STARTED, COMPLETED or FAILED."""
    if status not in (*OPEN, "COMPLETED", "FAILED"):
        raise ValueError(f"unknown run status: {status}")
    meta = json.dumps(dict(metadata)) if metadata else None
    return spark.createDataFrame(
        [(run_id, run_type, status, now, records_processed, error_message, meta)], RUN_EVENT_SCHEMA
    )


def latest_runs(events: DataFrame) -> DataFrame:
    """One row per run: its start, and the end, outcome and counts of its last event.

    Runs are told apart by id, so finishing one run never closes another run of its type.
    """
    # At equal times a terminal event is later than the event that opened the run.
    order = F.struct("event_at", (~F.col("status").isin(*OPEN)).alias("terminal"))
    last = F.max_by(F.struct("status", "event_at", "records_processed", "error_message", "metadata"), order)
    done = ~F.col("e.status").isin(*OPEN)
    return events.groupBy("run_id", "run_type").agg(F.min("event_at").alias("started_at"), last.alias("e")).select(
        "run_id", "run_type", "started_at", F.when(done, F.col("e.event_at")).alias("completed_at"),
        "e.status", "e.records_processed", "e.error_message", "e.metadata",
    )


def job_status(runs: DataFrame) -> DataFrame:
    """Totals over all runs: idle or running, last start, records, errors and open runs."""
    running = F.count_if(F.col("status") == "STARTED")
    return runs.agg(
        F.when(running > 0, "running").otherwise("idle").alias("status"),
        F.max("started_at").alias("last_run"),
        F.sum(F.when(F.col("status") == "COMPLETED", F.col("records_processed")).otherwise(0)).alias("records_processed"),
        F.count_if(F.col("status") == "FAILED").alias("errors"),
        running.alias("running_jobs"),
    )


def recent_runs(runs: DataFrame, run_type: str = "DEPLOYMENT", n: int = 5) -> DataFrame:
    return runs.where(F.col("run_type") == run_type).orderBy(F.desc("started_at"), "run_id").limit(n)


def service_log_parse(logs: DataFrame) -> DataFrame:
    """Time, severity and message of service log lines."""
    return logs.select("timestamp", F.get_json_object("record", "$.severity").alias("severity"),
                       F.col("value").cast("string").alias("message"))
