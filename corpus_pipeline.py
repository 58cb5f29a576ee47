"""From raw documents to token ids: quality filter, near-duplicate removal, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, catalog, minhash_dedup, mix, quality
from lectern.llm.runtime import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.where(F.col("score") >= catalog.KEEP_SCORE).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near copies: that of the smallest doc_id. Rows without a doc_id, or with a null text, stay.

    Different texts of one doc_id are judged as different documents. Of rows with one doc_id and text (or none), the smallest stays.
    Rows are shuffled once, to what was found about their text; those without a doc_id are not.
    """
    dropped = stored(minhash_dedup.repeated_texts(docs.select("doc_id", "text")), "repeated-texts")
    digest = F.unhex(F.md5("text"))
    key = docs.select("doc_id", digest.alias("digest")).where("doc_id is not null")
    again = key.groupBy("doc_id", "digest").count().where("count > 1").drop("count").withColumn("fate", F.lit("again"))
    fates = stored(dropped.withColumn("fate", F.lit("drop")).unionByName(again.join(dropped, ["doc_id", "digest"], "left_anti")), "fates")
    fates = fates.select(F.col("doc_id").alias("of"), "digest", "fate")
    # The same named rows on the left of both joins, so that Spark shuffles them once for the two.
    named = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("row"), digest.alias("own"))
    same = (F.col("row.doc_id") == F.col("of")) & F.col("own").eqNullSafe(F.col("digest"))
    one = named.join(fates, same, "left_anti")
    first = named.join(fates.where("fate = 'again'"), same).groupBy("of", "own").agg(F.min("row").alias("row"))
    return docs.where("doc_id is null").unionByName(one.select("row.*")).unionByName(first.select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each reading of a document that the target weights ask for, in training order."""
    return mix.realise(mix.plan_mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (little-endian unsigned 32-bit), n_tokens and the digest of the decoded bytes of each reading."""
    done = bpe.round_trip(docs, catalog.tokenizer(spark), keep=("doc_id", "source"))
    return done.select(
        "row.doc_id", "row.source", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [("quality", keep_quality), ("near duplicates", drop_near_duplicates), ("mix", mix_sources), ("tokens", encode)]

#: The classifier is not SQL; tests compare the stages after it with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs
