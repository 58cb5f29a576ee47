"""Landing tables: files become enveloped RAW rows in numbered batches.

RAW rows are never rewritten. A batch is pending until the batch log lists it, so the rows that a
run marks as processed are exactly the rows it read, however many land meanwhile.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.extract import land_raw
from lectern.schemas import ERROR, PENDING, PROCESSED, RAW_SCHEMA
from lectern.sources.store import Lake

BATCH_SCHEMA = f"{RAW_SCHEMA}, batch string"
# Both tables have one folder per entity and batch, which processing the batch again overwrites.
BATCH_LOG_SCHEMA = "row_count bigint, rejected_count bigint, processed_at timestamp_ntz, entity string, batch string"
REJECTED_SCHEMA = "raw_id string, reason string, entity string, batch string"
BATCH_NAME = re.compile(r"[\w.-]+")


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One payload per line, kept as text: a line that is not JSON still lands."""
    return spark.read.text(path).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file_name"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV rows with a header, as JSON payloads."""
    rows = spark.read.option("header", True).schema(schema).csv(path)
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("payload"), F.col("_metadata.file_path").alias("file_name"))


def land(lake: Lake, entity: str, payloads: DataFrame, batch: str, *, now: datetime) -> None:
    """Add one batch of payloads to the entity's landing table.

    Landing it again replaces it; if it was processed before, it is pending again.
    """
    name = F.col("file_name") if "file_name" in payloads.columns else None
    land_envelopes(lake, entity, land_raw(payloads, now=now, file_name=name), batch)


def land_envelopes(lake: Lake, entity: str, raw: DataFrame, batch: str) -> None:
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError(f"a batch name is a folder name of letters, digits, '_', '-' and '.': {batch!r}")
    # First the log, then the rows: a crash between the two only loads the old rows again.
    for table in ("audit/batch_log", "audit/rejected"):
        lake.drop_partition(table, f"entity={entity}", f"batch={batch}")
    lake.replace_partitions(f"raw/{entity}", raw.withColumn("batch", F.lit(batch)), "batch")


def pending_batches(lake: Lake, entity: str) -> list[str]:
    """Batches without a folder in the batch log; no rows are read, the two folder lists are compared."""
    done = set(lake.partitions("audit/batch_log", "batch", f"entity={entity}"))
    return [b for b in lake.partitions(f"raw/{entity}", "batch") if b not in done]


def read_batches(lake: Lake, entity: str, batches: list[str]) -> DataFrame:
    """Only the folders of those batches are read."""
    return lake.read(f"raw/{entity}", BATCH_SCHEMA, batches, "batch")


def raw_table(lake: Lake, entity: str) -> DataFrame:
    """All landed rows with their status: ERROR if rejected, PROCESSED if their batch is logged."""
    raw = lake.read(f"raw/{entity}", BATCH_SCHEMA).drop("processing_status")
    log = lake.read("audit/batch_log", BATCH_LOG_SCHEMA).where(F.col("entity") == entity)
    bad = lake.read("audit/rejected", REJECTED_SCHEMA).where(F.col("entity") == entity)
    done = log.select("batch", F.lit(PROCESSED).alias("done")).distinct()
    failed = bad.select("batch", "raw_id", F.lit(ERROR).alias("failed")).distinct()
    return raw.join(done, "batch", "left").join(failed, ["batch", "raw_id"], "left").select(
        "raw_id", "payload", "source_system", "file_name", "ingested_at",
        F.coalesce("failed", "done", F.lit(PENDING)).alias("processing_status"), "batch",
    )
