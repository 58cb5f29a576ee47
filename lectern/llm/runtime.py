"""Stored intermediate tables, package shipping to Python workers, and fixed-width hashes."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from lectern.session import scratch_dir

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose nodes do not share that folder, submit the package with ``--py-files``.
    """
    env = spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, ROOT])
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there, executors may be lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict[str, Callable[[], object]] = {}


def hold(owner: str, drop: Callable[[], object] | None = None) -> None:
    """Called where work starts in a Python worker: it keeps the memo tables of one operator at a time.

    Spark hands a worker from job to job; without this it would in time hold the tables of all operators it ever ran.
    ``drop`` empties the tables of ``owner`` when another one comes.
    """
    for other in [x for x in _HELD if x != owner]:
        _HELD.pop(other)()
        gc.enable()
        gc.collect()
    if drop is not None:
        _HELD[owner] = drop


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finaliser of splitmix64 over unsigned 64-bit integers; a bijection for each seed."""
    z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))
