"""Repeatable pseudo-random columns: the same id, salt and seed always give the same value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def draw(salt: str, seed: int, *ids: str | Column) -> Column:
    return F.xxhash64(F.lit(salt), F.lit(seed), *ids)


def between(low: int, high: int, salt: str, seed: int, *ids: str | Column) -> Column:
    """Uniform integer in [low, high]."""
    return (F.pmod(draw(salt, seed, *ids), F.lit(high - low + 1)) + low).cast("bigint")


def uniform(salt: str, seed: int, *ids: str | Column) -> Column:
    """Uniform double in [0, 1)."""
    return F.pmod(draw(salt, seed, *ids), F.lit(1 << 40)) / F.lit(float(1 << 40))


def normal(salt: str, seed: int, *ids: str | Column) -> Column:
    """Standard normal from two uniform draws."""
    u = (1 - uniform(salt + "/r", seed, *ids))
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * uniform(salt + "/a", seed, *ids))


def choice(values: Sequence, salt: str, seed: int, *ids: str | Column) -> Column:
    """One of ``values``; repeat a value to give it more weight."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, between(1, len(values), salt, seed, *ids).cast("int"))


def dense_index(df: DataFrame, key: str, column: str = "idx", buckets: int = 1024) -> DataFrame:
    """Number the rows 0..n-1 by unique ``key`` without sorting everything in one task.

    Rows are numbered inside hash buckets, and each bucket starts where the ones before it end. Only
    the bucket sizes, one row each, meet in one task.
    """
    bucketed = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("bucket").orderBy(key)) - 1
    return bucketed.withColumn("inside", inside).join(starts, "bucket").withColumn(
        column, F.col("start") + F.col("inside")
    ).drop("bucket", "inside", "start")
