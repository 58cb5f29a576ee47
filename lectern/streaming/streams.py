"""Keeping the curated tables, the alerts and the search index current with Structured Streaming.

The checkpoint remembers which files were read, so it takes the place of the status flag. Each sink
gives the same result when a micro-batch is run again after a failure.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from datetime import datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators import search, upsert
from lectern.operators.cost import CREDIT_RATE, HOURLY_LIMIT, NAME_PATTERN
from lectern.plans.jobs import load_rows, staging_path
from lectern.schemas import RAW_SCHEMA
from lectern.sources.segments import Segments
from lectern.sources.store import Lake


def read_landing(spark: SparkSession, path: str, *, fmt: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """New envelope files of a landing folder as a stream."""
    reader = spark.readStream.format(fmt).schema(RAW_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_upsert(raw: DataFrame, entity: str, lake: Lake, *, checkpoint: str, now: datetime) -> StreamingQuery:
    """Merge every micro-batch of landed rows into the curated table, note what cannot be read, then stop.

    Inside a micro-batch the last row by ingestion time wins; between micro-batches, the one that arrives later.
    The merge is keyed and the rejected rows belong to the micro-batch, so a batch that runs twice leaves the same rows.
    """
    stream = f"stream-{zlib.crc32(checkpoint.encode()):08x}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        run = f"{stream}-{batch_id}"
        load_rows(lake, entity, batch.withColumn("batch", F.lit(run)), run, now=now)
        lake.remove(staging_path(lake, entity, run))

    return raw.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_insert_once(rows: DataFrame, lake: Lake, table: str, schema: str, *, key: str, checkpoint: str,
                       time: str | None = None, delay: str | None = None) -> StreamingQuery:
    """Append rows whose key was not seen before, however late they come.

    Copies are dropped inside the micro-batch and against the stored table. With ``time`` and
    ``delay`` the stream's own state drops copies first, at the price of ignoring rows later than
    ``delay``. Each micro-batch owns one partition, which a rerun overwrites.
    """
    if delay is not None:
        rows = rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])

    def insert(batch: DataFrame, batch_id: int) -> None:
        stored = lake.read(table, f"{schema}, batch bigint").where(F.col("batch") != batch_id)
        fresh = upsert.not_in(batch.dropDuplicates([key]), stored, [key])
        lake.replace_partitions(table, fresh.withColumn("batch", F.lit(batch_id).cast("bigint")), "batch")

    return rows.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_spend(metering: DataFrame, *, delay: str = "1 hour", like: str = NAME_PATTERN,
                 rate: Decimal = CREDIT_RATE) -> DataFrame:
    """Cost per warehouse and clock hour; ``start_time`` is the event time."""
    return metering.where(F.col("warehouse_name").like(like)).withWatermark("start_time", delay).groupBy(
        F.window("start_time", "1 hour").alias("w"), "warehouse_name"
    ).agg((F.sum("credits_used") * F.lit(rate)).alias("usd")).select(
        F.col("w.start").cast("timestamp_ntz").alias("usage_hour"), "warehouse_name",
        F.col("usd").alias("estimated_cost_usd"),
    )


def stream_hourly_spike(metering: DataFrame, path: str, *, checkpoint: str, limit: Decimal = HOURLY_LIMIT,
                        delay: str = "1 hour") -> StreamingQuery:
    """Store each closed hour in which a warehouse cost more than ``limit``.

    An hour is closed once the stream has seen a time ``delay`` past its end; later rows for it are ignored.
    """
    spikes = hourly_spend(metering, delay=delay).where(F.col("estimated_cost_usd") > F.lit(limit))
    return spikes.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()


#: What is stored of an hour: its credits after ``version`` revisions. ``day`` is the folder.
SPEND_SCHEMA = "usage_hour timestamp_ntz, warehouse_name string, credits decimal(38,9), version bigint, day string"


def _revised(rows: DataFrame) -> DataFrame:
    """The last revision of every hour."""
    last = F.max_by(F.struct("credits", "version"), "version").alias("last")
    return rows.groupBy("usage_hour", "warehouse_name", "day").agg(last).select("usage_hour", "warehouse_name", "last.credits", "last.version", "day")


def stream_spend(metering: DataFrame, lake: Lake, name: str, *, checkpoint: str, like: str = NAME_PATTERN) -> StreamingQuery:
    """Keep the credits of every warehouse and clock hour current, however late or out of order rows come.

    A micro-batch is summed by hour; each hour it touches gets a next revision, from its own rows and the last revision, which is read from
    the folders of the touched days. Revisions are segments merged by levels, so an hour is rewritten once per level. The list that names a
    new segment also notes the micro-batch: one that runs again finds itself noted and adds nothing. Rows without a time are ignored.
    """
    stream, table = f"stream-{zlib.crc32(checkpoint.encode()):08x}", Segments(lake, name)
    keys = ["usage_hour", "warehouse_name"]

    def revise(batch: DataFrame, batch_id: int) -> None:
        info = table.info()
        if info.get(stream, -1) < batch_id:
            hour = F.date_trunc("hour", "start_time").cast("timestamp_ntz")
            path = f"{table.base}/staging/{stream}"
            batch.where(F.col("warehouse_name").like(like) & F.col("start_time").isNotNull()).groupBy(
                hour.alias("usage_hour"), "warehouse_name", F.date_format(hour, "yyyy-MM-dd").alias("day")
            ).agg(
                F.sum("credits_used").cast("decimal(38,9)").alias("credits"), F.max(F.col("start_time").cast("timestamp_ntz")).alias("latest")
            ).write.mode("overwrite").parquet(path)
            hours = lake.spark.read.parquet(path)
            # One row for each day that the micro-batch touches.
            days = hours.groupBy("day").agg(F.max("latest").alias("latest")).collect()
            if not days:
                table.note(**{stream: batch_id})
                return
            before = _revised(table.read(SPEND_SCHEMA, column="day", values=[r.day for r in days])).select(
                *keys, F.col("credits").alias("old_credits"), F.col("version").alias("old_version"))
            credits = F.coalesce(F.col("credits"), F.lit(0)) + F.coalesce(F.col("old_credits"), F.lit(0))
            revised = hours.join(before, keys, "left").select(
                *keys, credits.cast("decimal(38,9)").alias("credits"),
                (F.coalesce(F.col("old_version"), F.lit(0)) + 1).cast("bigint").alias("version"), "day")
            seen = max([r.latest.isoformat() for r in days] + ([info["seen"]] if "seen" in info else []), key=datetime.fromisoformat)
            table.add(revised, f"{stream}-{batch_id}", "day", info={stream: batch_id, "seen": seen, "ended": False})
        table.merge(SPEND_SCHEMA, _revised, "day")

    return metering.writeStream.foreachBatch(revise).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def end_spend(lake: Lake, name: str) -> None:
    """Nothing more will come: all hours are closed, until something does come."""
    Segments(lake, name).note(ended=True)


def spend_hours(lake: Lake, name: str, *, delay: timedelta = timedelta(hours=1), limit: Decimal = HOURLY_LIMIT,
                rate: Decimal = CREDIT_RATE) -> DataFrame:
    """usage_hour, warehouse_name, estimated_cost_usd, version, spike (more than ``limit``) and state of every hour.

    An hour is OPEN, its cost provisional, until a time ``delay`` past its end was seen or the input has ended; then it is CLOSED.
    A row that comes later still is counted and raises the version.
    """
    table = Segments(lake, name)
    info = table.info()
    usd = F.col("credits") * F.lit(rate)
    if info.get("ended"):
        closed = F.lit(True)
    elif "seen" in info:
        closed = F.col("usage_hour") <= F.lit((datetime.fromisoformat(info["seen"]) - delay - timedelta(hours=1)).isoformat(" ")).cast("timestamp_ntz")
    else:
        closed = F.lit(False)
    return _revised(table.read(SPEND_SCHEMA)).select(
        "usage_hour", "warehouse_name", usd.alias("estimated_cost_usd"), "version",
        F.coalesce(usd > F.lit(limit), F.lit(False)).alias("spike"), F.when(closed, "CLOSED").otherwise("OPEN").alias("state"))


#: An index in segments: what each micro-batch said of its documents (``seen``), and their ``docs`` and ``postings``.
INDEX_COLUMNS = "doc_id string, batch bigint, title string, doc_len int, term string, tf bigint"


def _index_schema(attributes: str) -> str:
    return f"{INDEX_COLUMNS}{', ' + attributes if attributes else ''}, part string"


def _newest_word(rows: DataFrame) -> DataFrame:
    """Of every document what its last micro-batch here said; that it was seen stays, since older segments may hold it."""
    last = rows.where("part = 'seen'").groupBy("doc_id").agg(F.max("batch").alias("batch"))
    kept = rows.join(last, ["doc_id", "batch"], "left_semi").drop("seg")
    return kept.sortWithinPartitions("part", "term", "doc_id")


def stream_index(source: DataFrame, corpus: search.Corpus, lake: Lake, name: str, *, checkpoint: str,
                 order: Iterable[str]) -> StreamingQuery:
    """Keep a stored index current with the documents of every micro-batch.

    Of copies in one micro-batch the last by ``order`` counts, and a later micro-batch replaces what earlier ones say of its
    documents. Run it as often as the corpus' target lag asks. A micro-batch adds one segment, and segments are merged by levels: a
    posting is rewritten once per level, replaced documents go when they meet their replacement, and the number of segments grows
    with the logarithm of the micro-batches. The list of segments notes the micro-batch, so one that runs again adds nothing.
    """
    order, table = list(order), Segments(lake, name)
    stream = f"stream-{zlib.crc32(checkpoint.encode()):08x}"
    attributes = ", ".join(f"attr_{a} {source.schema[a].dataType.simpleString()}" for a in corpus.attributes)
    schema = _index_schema(attributes)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        info = table.info()
        if info.get(stream, -1) < batch_id:
            # Streams over one index take turns; what comes later replaces what came before.
            number = info.get("batches", 0) + 1
            path = f"{table.base}/staging/{stream}"
            upsert.latest_per_key(batch, [corpus.id], order=order).write.mode("overwrite").parquet(path)
            last = lake.spark.read.parquet(path)
            index = search.build_index(last, corpus)
            seen = last.select(F.col(corpus.id).alias("doc_id"))
            parts = [df.withColumn("part", F.lit(part)) for part, df in (("seen", seen), ("docs", index.docs), ("postings", index.postings))]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).withColumn("batch", F.lit(number))
            columns = [F.col(c).cast(t) for c, t in (x.split(" ", 1) for x in schema.split(", ")) if c in rows.columns]
            table.add(rows.select(columns), f"{stream}-{batch_id}", "part",
                      info={stream: batch_id, "batches": number, "attributes": attributes})
        table.merge(schema, _newest_word, "part")

    return source.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_index(lake: Lake, name: str, corpus: search.Corpus) -> search.Index:
    """The index with only the newest word on each document; a document whose text became NULL is gone."""
    table = Segments(lake, name)
    schema, live = _index_schema(table.info().get("attributes", "")), table.live()
    read = lambda part: table.read(schema, segments=live, column="part", values=[part])
    seen = read("seen").select("doc_id", "batch")
    newest = seen.groupBy("doc_id").agg(F.max("batch").alias("newest"), F.min("batch").alias("oldest"))
    # Only documents that came again since their segments were merged have old rows to leave out.
    again = newest.where("newest > oldest").select("doc_id", "newest")
    old = seen.join(again, "doc_id").where("batch < newest").select("doc_id", "batch")
    docs, postings = (read(part).join(old, ["doc_id", "batch"], "left_anti") for part in ("docs", "postings"))
    attrs = [f"attr_{a}" for a in corpus.attributes]
    return search.Index(docs.select("doc_id", "title", "doc_len"), postings.select("term", "doc_id", "doc_len", *attrs, "tf"), corpus.attributes)
