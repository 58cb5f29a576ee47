"""Schema on read: JSON payloads to typed columns, and the rows that cannot be read."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.schemas import ENTITIES, PENDING


def land_raw(payloads: DataFrame, *, now: datetime, source_system: str = "CANVAS_LMS",
             file_name: str | Column | None = None, raw_id: Column | None = None) -> DataFrame:
    """Wrap a ``payload`` column in the landing envelope, every row PENDING."""
    name = file_name if isinstance(file_name, Column) else F.lit(file_name)
    return payloads.select(
        (raw_id if raw_id is not None else F.expr("uuid()")).alias("raw_id"),
        F.col("payload").cast("string").alias("payload"),
        F.lit(source_system).alias("source_system"),
        name.cast("string").alias("file_name"),
        F.lit(now).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(PENDING).alias("processing_status"),
    )


def _typed(text: Column, to: str) -> Column:
    if to == "string":
        return text
    if to in ("bigint", "int"):
        # A JSON number such as 12.0 or 12.7 is a valid integer source and rounds half up.
        return F.round(text.try_cast("decimal(38,10)"), 0).try_cast(to)
    return text.try_cast(to)


def extract(raw: DataFrame, entity: str, *, status: str | None = PENDING, keep: Iterable[str] = ()) -> DataFrame:
    """Typed payload columns of the rows in ``status`` (``None`` for all rows).

    The payload is parsed once per row into text fields and each field is cast by itself: a missing
    key or a value of the wrong type gives NULL in that column only. Rows without a readable natural
    id are left out here and listed by :func:`rejected`.
    """
    spec = ENTITIES[entity]
    if status is not None:
        raw = raw.where(F.col("processing_status") == status)
    # A generator is evaluated once; the filter on its output cannot repeat the parsing.
    text = {c: f"text_{c}" for c in spec.fields}
    parsed = raw.select(F.json_tuple("payload", *text).alias(*text.values()), *keep)
    typed = [_typed(F.col(text[c]), t).alias(c) for c, t in spec.fields.items()]
    return parsed.where(F.col(text[spec.key]).isNotNull()).select(*typed, *keep)


def parsed(raw: DataFrame, entity: str, *, keep: Iterable[str] = ()) -> DataFrame:
    """Typed payload columns of all rows, and the ``reason`` where a row cannot be loaded; one parse per row."""
    spec = ENTITIES[entity]
    text = {c: f"text_{c}" for c in spec.fields}
    found = raw.select(F.json_tuple("payload", *text).alias(*text.values()), "payload", *keep)
    typed = [_typed(F.col(text[c]), t).alias(c) for c, t in spec.fields.items()]
    return found.select(*typed, _reason(F.col(text[spec.key])).alias("reason"), *keep)


def _reason(natural_id: Column) -> Column:
    malformed = F.when(F.try_parse_json("payload").isNull(), "MALFORMED_JSON").otherwise("MISSING_KEY")
    return F.when(natural_id.isNull(), malformed)


def rejected(raw: DataFrame, entity: str, *, status: str | None = PENDING) -> DataFrame:
    """The rows :func:`extract` leaves out, with the reason."""
    spec = ENTITIES[entity]
    if status is not None:
        raw = raw.where(F.col("processing_status") == status)
    found = raw.select("raw_id", "file_name", "ingested_at", "payload",
                       F.json_tuple("payload", spec.key).alias("natural_id"))
    return found.where(F.col("natural_id").isNull()).select(
        "raw_id", "file_name", "ingested_at", _reason(F.col("natural_id")).alias("reason"))


def validate_raw_json(raws: dict[str, DataFrame]) -> DataFrame:
    """Per landing table: rows, rows that parse and rows that do not."""
    out = None
    for name, raw in raws.items():
        ok = F.try_parse_json("payload").isNotNull()
        part = raw.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(ok).alias("valid_rows"),
            F.count_if(~ok).alias("malformed_rows"),
        ).select(F.lit(name).alias("table_name"), "total_rows", "valid_rows", "malformed_rows")
        out = part if out is None else out.unionByName(part)
    return out


def preview(raw: DataFrame, entity: str, columns: Iterable[str], n: int = 10) -> DataFrame:
    """The first ``n`` parsed rows by natural id."""
    return extract(raw, entity, status=None).select(*columns).orderBy(ENTITIES[entity].key).limit(n)
