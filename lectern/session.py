"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import SparkSession


def build_session(
    cpus: str | int = "*", *, app: str = "lectern", shuffle_partitions: int = 8, scratch: str | None = None
) -> SparkSession:
    """Local session for tests and the bench; on a cluster the caller brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LECTERN_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column slows the building of wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return (builder.config("spark.checkpoint.dir", scratch) if scratch else builder).getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every stored time is zone-free; streaming needs zoned timestamps, so both must mean UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: A join's side whose shuffled partitions are all below this is hashed instead of sorted: keys are texts that begin alike, and slow to sort.
HASHED_BYTES = 16 * 2**20


_SHUFFLE_SETTINGS = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")


def use_light_shuffles(spark: SparkSession, light: bool = True, hashed: bool = True) -> SparkSession:
    """How jobs of many executions run, or again Spark's own way; what they give is the same.

    An execution leaves its shuffle files behind until the driver happens to collect garbage; with ``light`` they go when it ends. With
    ``hashed``, adaptive execution hashes a join's side that is small in every partition; larger ones are sorted and may spill. Hashed
    rows stay in the order in which they came and compress less, so what has to shuffle or store little keeps to sorting.
    """
    for name in _SHUFFLE_SETTINGS:
        spark.conf.unset(name)
    if light:
        spark.conf.set(_SHUFFLE_SETTINGS[0], "true")
    if not hashed:
        return spark
    # Spark asks that the limit is no smaller than the size it merges partitions to.
    merged = spark._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(merged)
    spark.conf.set(_SHUFFLE_SETTINGS[1], str(max(HASHED_BYTES, least)))
    return spark


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``, or in the warehouse where that is unset.

    All scratch folders of a session go when its process ends, or by ``clear_scratch``.
    """
    root = _scratch_root(spark)
    if root not in _CLEARED_AT_EXIT:
        _CLEARED_AT_EXIT.add(root)
        atexit.register(_clear_at_exit, spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this session wrote to its scratch folder; frames that read it can no longer be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEARED_AT_EXIT: set[str] = set()


def _clear_at_exit(spark: SparkSession) -> None:
    # A session that was stopped has no file system to ask any more.
    if spark.sparkContext._jsc is not None:
        clear_scratch(spark)
