"""Keyed upserts and row-state changes as plain DataFrame rewrites."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.schemas import ENTITIES, ERROR, PENDING, PROCESSED, Entity

BATCH_ORDER = ("ingested_at", "raw_id")


def latest_per_key(source: DataFrame, keys: Iterable[str], order: Iterable[str] = BATCH_ORDER,
                   *, on_duplicate: str = "last", keep_order: bool = True) -> DataFrame:
    """One row per key: the last by ``order``.

    An aggregate rather than a window, so copies of a hot key collapse before the shuffle. Without ``keep_order`` the
    result lacks the order's columns, which then travel once, as what is compared, and not among the values, too.
    ``on_duplicate="error"`` fails the job on the first key that appears twice.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in source.columns if c not in keys and (keep_order or c not in order)]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("r")
    if on_duplicate == "last":
        return source.groupBy(*keys).agg(best).select(*keys, "r.*")
    if on_duplicate != "error":
        raise ValueError(f"unknown duplicate rule: {on_duplicate}")
    found = source.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("copies"))
    message = F.concat(F.lit("duplicate key in batch: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    checked = F.when(F.col("copies") == 1, F.col(keys[0])).otherwise(F.raise_error(message).cast("string"))
    return found.withColumn(keys[0], checked).select(*keys, "r.*")


def upsert(target: DataFrame, source: DataFrame, *, keys: Iterable[str], update_cols: Iterable[str],
           now: datetime, insert_cols: Iterable[str] | None = None, defaults: Mapping[str, str] | None = None,
           stored_source: bool = False) -> DataFrame:
    """MERGE as a rewrite: matched rows take ``update_cols``, unmatched source rows are inserted.

    ``source`` holds one row per key. Columns of ``target`` that the source lacks start as their
    default or NULL. The merge is one full outer join, which reads the source once. A caller whose
    source is a stored table says so; it is then read twice, by a left join to the target and by an
    anti join, and Spark need not shuffle the target where the stored source is small.
    """
    keys, update_cols = list(keys), list(update_cols)
    defaults = dict(defaults or {})
    insertable = set(insert_cols) if insert_cols is not None else set(source.columns)
    stamp = F.lit(now).cast("timestamp_ntz")
    types = dict(target.dtypes)

    def fresh(c: str, prefix: str):
        if c in insertable and c in source.columns:
            return F.col(f"{prefix}{c}")
        if c in ("created_at", "updated_at"):
            return stamp
        return F.expr(defaults[c]) if c in defaults else F.lit(None)

    def kept(c: str):
        if c == "updated_at":
            return F.when(F.col("s.in_source"), stamp).otherwise(F.col("t.updated_at"))
        if c in update_cols:
            return F.when(F.col("s.in_source"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        return F.col(f"t.{c}")

    s = source.withColumn("in_source", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    if stored_source:
        merged = target.alias("t").join(s, on, "left").select(
            *[kept(c).cast(types[c]).alias(c) for c in target.columns]
        )
        added = not_in(source, target, keys).select(
            *[fresh(c, "").cast(types[c]).alias(c) for c in target.columns]
        )
        return merged.unionByName(added)
    t = target.withColumn("in_target", F.lit(True)).alias("t")
    cols = []
    for c in target.columns:
        old, new = kept(c), fresh(c, "s.")
        cols.append(F.when(F.col("t.in_target"), old).otherwise(new).cast(types[c]).alias(c))
    return t.join(s, on, "full_outer").select(*cols)


def not_in(source: DataFrame, target: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Source rows whose key the target lacks.

    The target is first cut down to the keys the source asks for, so a small batch never makes the
    whole target's keys shuffle.
    """
    keys = list(keys)
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    return source.join(known, keys, "left_anti")


def insert_new(target: DataFrame, source: DataFrame, *, keys: Iterable[str], now: datetime) -> DataFrame:
    """Target plus the source rows with unseen keys; existing rows never change."""
    added = not_in(source, target, keys)
    types = dict(target.dtypes)
    cols = []
    for c in target.columns:
        value = F.col(c) if c in source.columns else F.lit(now) if c == "created_at" else F.lit(None)
        cols.append(value.cast(types[c]).alias(c))
    return target.unionByName(added.select(*cols))


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Plain append by column name; a replayed batch is stored twice."""
    return target.unionByName(source.select(*[c for c in target.columns if c in source.columns]),
                              allowMissingColumns=True)


def lookup_keys(fact: DataFrame, entity: str, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Add each looked-up dimension key; NULL where the dimension row is not there yet."""
    for fk, (dim, natural) in ENTITIES[entity].lookups.items():
        surrogate = ENTITIES[dim].surrogate
        found = dims[dim].select(F.col(natural), F.col(surrogate).alias(fk))
        fact = fact.join(found, natural, "left")
    return fact


def backfill_keys(fact: DataFrame, entity: str, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fill keys that were NULL because the dimension arrived after its fact.

    Only rows with a missing key take part in the joins.
    """
    fks = list(ENTITIES[entity].lookups)
    complete = F.lit(True)
    for fk in fks:
        complete = complete & F.col(fk).isNotNull()
    open_rows = fact.where(~complete)
    found = lookup_keys(open_rows.withColumnsRenamed({fk: f"old_{fk}" for fk in fks}), entity, dims)
    filled = found.select(*[
        F.coalesce(f"old_{c}", c).alias(c) if c in fks else F.col(c) for c in fact.columns
    ])
    return fact.where(complete).unionByName(filled)


def number_rows(df: DataFrame, column: str, top: int | Column) -> DataFrame:
    """Number the rows whose ``column`` is NULL above ``top``.

    Numbers are unique and grow, with gaps between partitions; write the result once and read the
    keys back, since a second run may number the rows differently.
    """
    fresh = (F.lit(top) if isinstance(top, int) else top) + F.monotonically_increasing_id() + 1
    return df.withColumn(column, F.coalesce(F.col(column), fresh).cast("bigint"))


def assign_keys(df: DataFrame, column: str, existing: DataFrame | None = None) -> DataFrame:
    """Number the rows whose ``column`` is NULL above the greatest key of ``existing``, which is read for it."""
    top = (existing if existing is not None else df).agg(F.coalesce(F.max(column), F.lit(0))).scalar()
    return number_rows(df, column, top)


def merge_entity(spec: Entity, target: DataFrame, source: DataFrame, *, now: datetime,
                 profile: str = "full", on_duplicate: str = "last", stored_source: bool = False) -> DataFrame:
    """The upsert of one entity with its own key, update columns and defaults.

    A source without batch columns already holds one row per key.
    """
    if set(BATCH_ORDER) <= set(source.columns):
        source = latest_per_key(source, [spec.key], on_duplicate=on_duplicate)
    if not spec.updates:
        return insert_new(target, source, keys=[spec.key], now=now)
    skipped = spec.narrow_skips if profile == "sql" else ()
    return upsert(target, source, keys=[spec.key], update_cols=spec.update_cols(profile), now=now,
                  insert_cols=[c for c in source.columns if c not in skipped], defaults=spec.defaults,
                  stored_source=stored_source)


def pending_counts(raws: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, raw in raws.items():
        part = raw.where(F.col("processing_status") == PENDING).agg(F.count(F.lit(1)).alias("pending"))
        part = part.select(F.lit(name).alias("table_name"), "pending")
        out = part if out is None else out.unionByName(part)
    return out


def mark(raw: DataFrame, ids: DataFrame, status: str) -> DataFrame:
    """Set ``status`` on exactly the rows whose ``raw_id`` is in ``ids``.

    The batch is bound by its ids, so rows that land while it runs keep their own status.
    """
    hit = ids.select("raw_id").distinct().withColumn("hit", F.lit(True))
    return raw.join(hit, "raw_id", "left").select(*[
        F.when(F.col("hit"), F.lit(status)).otherwise(F.col(c)).alias(c) if c == "processing_status" else F.col(c)
        for c in raw.columns
    ])


def mark_processed(raw: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """PENDING to PROCESSED, for all pending rows or only those of a bound batch."""
    if ids is not None:
        return mark(raw, ids, PROCESSED)
    status = F.col("processing_status")
    return raw.withColumn("processing_status", F.when(status == PENDING, PROCESSED).otherwise(status))


def mark_error(raw: DataFrame, ids: DataFrame) -> DataFrame:
    return mark(raw, ids, ERROR)


def touch_active_students(dim: DataFrame, *, now: datetime) -> DataFrame:
    """Active students last touched more than an hour ago become current as of ``now``."""
    stamp = F.lit(now).cast("timestamp_ntz")
    stale = (F.col("enrollment_status") == "Active") & (F.col("updated_at") < stamp - F.expr("INTERVAL '1' HOUR"))
    return dim.withColumns({
        "updated_at": F.when(stale, stamp).otherwise(F.col("updated_at")),
        "is_current": F.when(stale, F.lit(True)).otherwise(F.col("is_current")),
    })


def refresh_current_courses(dim: DataFrame, *, now: datetime) -> DataFrame:
    """Courses not flagged current, or not flagged at all, become current as of ``now``."""
    lapsed = ~F.coalesce(F.col("is_current"), F.lit(False))
    return dim.withColumns({
        "updated_at": F.when(lapsed, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("updated_at")),
        "is_current": F.lit(True),
    })
