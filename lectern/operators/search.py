"""Batch text search: search documents, an inverted index, and ranked top-k answers.

Ranking is BM25. The index is two append-friendly frames, so new documents are added without
rebuilding; corpus statistics are taken from the index when a query runs.

A stored index knows of each block of a term's postings the greatest count and the shortest document, which bound what a document of the
block can get. A search scores the best blocks of every asked term first; the k-th score that comes of it is one that the answers
reach at least. Blocks that cannot reach it, even with the best block of every other term, are then left unread. Answers are the same.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.session import scratch_dir

K1, B = 1.2, 0.75
SCORE_DIGITS = 6
#: Postings of a block are neighbours in the stored order, 2**BLOCK_BITS at most; the blocks of each term that a search reads first.
BLOCK_BITS, FIRST_BLOCKS = 9, 2


def _or(column: str, default: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(default))


def activity_search_source(activity: DataFrame) -> DataFrame:
    text = F.concat(
        F.col("activity_type"), F.lit(" activity on "), _or("page_url", "unknown page"), F.lit(" using "),
        _or("device_type", "unknown device"), F.lit(" ("), _or("browser", "unknown browser"), F.lit(") for "),
        _or("duration_seconds", "0"), F.lit(" seconds"),
    )
    return activity.select(
        "activity_id", "student_id", "course_id", "activity_type", "activity_timestamp", "duration_seconds",
        "page_url", "device_type", "browser", text.alias("search_text"),
        F.to_date("activity_timestamp").alias("activity_date"),
    )


def course_search_source(courses: DataFrame) -> DataFrame:
    text = F.concat(
        F.col("course_code"), F.lit(" - "), F.col("course_name"),
        F.lit(". Department: "), _or("department", "Unknown"), F.lit(". Instructor: "), _or("instructor_name", "TBD"),
        F.lit(". Credits: "), _or("credit_hours", "N/A"), F.lit(". Level: "), _or("course_level", "Unknown"),
        F.lit(". Delivery: "), _or("delivery_mode", "Unknown"), F.lit(". Term: "), _or("term", "Unknown"),
    )
    return courses.select(
        "course_id", "canvas_course_id", "course_code", "course_name", "department", "credit_hours", "course_level",
        "delivery_mode", "term", "academic_year", "instructor_name", "start_date", "end_date", "max_enrollment",
        text.alias("search_text"),
    )


def student_search_source(students: DataFrame) -> DataFrame:
    name = F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
    text = F.concat(
        name, F.lit(". Major: "), _or("major", "Undeclared"), F.lit(". Classification: "),
        _or("classification", "Unknown"), F.lit(". Status: "), _or("enrollment_status", "Unknown"),
        F.lit(". GPA: "), _or("gpa", "N/A"), F.lit(". Email: "), _or("email", "N/A"),
    )
    return students.select(
        "student_id", "canvas_user_id", "first_name", "last_name", name.alias("full_name"), "email", "major",
        "classification", "enrollment_status", "gpa", "advisor_id", "enrollment_date", "expected_graduation",
        text.alias("search_text"),
    )


@dataclass(frozen=True)
class Corpus:
    """Which columns of a search source are its id, title and filterable attributes."""

    id: str
    title: str
    attributes: tuple[str, ...]
    target_lag: str
    max_results: int = 10


ACTIVITY_CORPUS = Corpus("activity_id", "activity_type", ("activity_type", "activity_date"), "1 hour")
COURSE_CORPUS = Corpus("course_id", "course_name", ("department", "term", "course_level", "delivery_mode"), "1 day")
STUDENT_CORPUS = Corpus("student_id", "full_name", ("major", "classification", "enrollment_status"), "1 day")


@dataclass(frozen=True)
class Index:
    """``docs``: doc_id, title, doc_len. ``postings``: term, doc_id, tf, doc_len and the attributes.

    A stored index also has ``terms``: term and df, its number of documents; and ``blocks``: tier, term and block of its postings with
    the number of postings, the greatest tf, the shortest doc_len and the smallest doc_id. ``words`` are the documents that an index is built from.
    """

    docs: DataFrame
    postings: DataFrame
    attributes: tuple[str, ...]
    terms: DataFrame | None = None
    blocks: DataFrame | None = None
    words: DataFrame | None = None


def tokens(text: Column) -> Column:
    """Lower-case runs of letters a-z and digits, over the whole text."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def tier() -> Column:
    """Eighths of an octave of words per occurrence: postings of one tier are worth about the same."""
    return F.floor(8 * F.log2(F.col("doc_len").cast("double") / F.col("tf"))).cast("int")


def build_index(source: DataFrame, corpus: Corpus, *, text: str = "search_text") -> Index:
    """Index the documents that have a text; a document with NULL text is not searchable."""
    words = source.where(F.col(text).isNotNull()).select(
        F.col(corpus.id).alias("doc_id"), F.col(corpus.title).cast("string").alias("title"),
        *[F.col(a).alias(f"attr_{a}") for a in corpus.attributes], tokens(F.col(text)).alias("words"),
    ).withColumn("doc_len", F.size("words"))
    return Index(words.select("doc_id", "title", "doc_len"), _postings(words, corpus.attributes), corpus.attributes, words=words)


def _postings(words: DataFrame, attributes: Iterable[str]) -> DataFrame:
    attrs = [f"attr_{a}" for a in attributes]
    # One shuffle: laid out by term and document, the words are counted where they are and stored as they lie.
    return (
        words.select(F.explode("words").alias("term"), "doc_id", "doc_len", *attrs).repartitionByRange("term", "doc_id")
        .groupBy("term", "doc_id", "doc_len", *attrs).agg(F.count(F.lit(1)).alias("tf"))
    )


def save_index(index: Index, path: str, *, blocks: bool = False) -> None:
    """Store an index and its document frequencies. Postings are laid out by term, and a common term may span many files.

    ``blocks`` adds what a search needs to leave postings unread; it pays for an index that is searched more often than it is built.
    """
    spark = index.postings.sparkSession
    read = lambda part: spark.read.parquet(f"{path}/{part}")
    postings = index.postings
    if index.words is None:
        index.docs.write.parquet(f"{path}/docs")
    else:
        # Laying out the postings reads the documents twice; what they come from is computed once.
        index.words.write.parquet(f"{path}/docs")
        postings = _postings(read("docs"), index.attributes)
    if not blocks:
        postings.sortWithinPartitions("term", "doc_id").write.parquet(f"{path}/postings")
        document_frequency(spark.read.schema(index.postings.schema).parquet(f"{path}/postings")).write.parquet(f"{path}/terms")
        return
    blocked(postings).write.partitionBy("tier").parquet(f"{path}/postings")
    blocks_of(read("postings")).write.parquet(f"{path}/blocks")
    read("blocks").groupBy("term").agg(F.sum("n").alias("df")).write.parquet(f"{path}/terms")


def blocked(postings: DataFrame) -> DataFrame:
    """Postings in stored order with their tier and the number of their block."""
    ordered = postings.withColumn("tier", tier()).sortWithinPartitions("tier", "term", "doc_id")
    return ordered.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS))


def blocks_of(postings: DataFrame) -> DataFrame:
    return postings.groupBy("tier", "term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("tf"), F.min("doc_len").alias("doc_len"), F.min("doc_id").alias("least_id"))


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def load_index(spark: SparkSession, path: str, corpus: Corpus, *, blocks: bool = False) -> Index:
    """A stored index; with ``blocks`` if they were stored with it."""
    docs, postings, terms = (spark.read.parquet(f"{path}/{part}") for part in ("docs", "postings", "terms"))
    return Index(docs.select("doc_id", "title", "doc_len"), postings, corpus.attributes, terms, spark.read.parquet(f"{path}/blocks") if blocks else None)


def refresh_index(index: Index, changed: Index) -> Index:
    """Replace the changed documents and keep the others."""
    ids = changed.docs.select("doc_id")
    return Index(
        index.docs.join(ids, "doc_id", "left_anti").unionByName(changed.docs),
        index.postings.join(ids, "doc_id", "left_anti").unionByName(changed.postings),
        index.attributes,
    )


def search(index: Index, queries: DataFrame, *, k: int = 10, where: dict[str, Iterable] | None = None) -> DataFrame:
    """The ``k`` best documents per row of ``queries`` (query_id, query).

    ``where`` maps attributes to accepted values. It narrows the answers, not the corpus statistics.
    Equal scores are ordered by document id.
    """
    for a in where or {}:
        if a not in index.attributes:
            raise KeyError(f"{a} is not an attribute of this index")
    asked = queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term")).distinct()
    terms = index.terms if index.terms is not None else document_frequency(
        index.postings.join(asked.select("term").distinct(), "term", "left_semi"))
    hits = index.postings
    for a, values in (where or {}).items():
        hits = hits.where(F.col(f"attr_{a}").isin(*values))
    corpus = index.docs.agg(F.count(F.lit(1)).cast("double").alias("size"), F.sum("doc_len").cast("double").alias("words"))
    if index.blocks is None:
        size, avg_len = corpus.select("size").scalar(), corpus.select(F.col("words") / F.nullif("size", F.lit(0))).scalar()
        weighed = asked.join(terms, "term").withColumn("idf", _idf(size))
        best = _best(_scores(hits, weighed, ["term"], avg_len), k)
    else:
        size, words = corpus.first()
        avg_len = F.lit(words / size if size else None).cast("double")
        weighed = asked.join(terms, "term").withColumn("idf", _idf(F.lit(size)))
        best = _best(_scores(hits, _worthwhile(index, hits, weighed, avg_len, k), ["tier", "term", "block"], avg_len), k)
    titles = index.docs.select("doc_id", "title")
    return best.join(titles, "doc_id").select("query_id", "rank", "doc_id", "title", "score")


def _idf(size: Column) -> Column:
    return F.log(1 + (size - F.col("df") + 0.5) / (F.col("df") + 0.5))


def _part(avg_len: Column) -> Column:
    """What a posting adds to a score; it grows with tf and shrinks with doc_len."""
    tf = F.col("tf").cast("double")
    return F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("doc_len") / avg_len))


def _scores(hits: DataFrame, weighed: DataFrame, on: list[str], avg_len: Column) -> DataFrame:
    # The postings are partitioned for this join alone, so adaptive execution can split a term that most documents have.
    # Parts are summed as decimals: the score does not depend on their order.
    total = F.sum(_part(avg_len).cast("decimal(38,12)"))
    if "tier" in on:
        # Tiers are folders; the numbers of those that are asked for are few.
        hits = hits.where(F.col("tier").isin([r[0] for r in weighed.select("tier").distinct().collect()]))
    return hits.join(weighed.select("query_id", "idf", *on), on).groupBy("query_id", "doc_id").agg(
        F.round(total, SCORE_DIGITS).cast("double").alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    # A rank filter is cut to k rows per query on the map side, so a hot query never meets in one task.
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _worthwhile(index: Index, hits: DataFrame, weighed: DataFrame, avg_len: Column, k: int) -> DataFrame:
    """The blocks of asked terms that may hold one of a query's ``k`` best documents, with query and idf."""
    path = scratch_dir(hits.sparkSession, "blocks")
    weighed.join(index.blocks, "term").withColumn("bound", _part(avg_len)).write.parquet(path)
    blocks = hits.sparkSession.read.parquet(path)
    place = F.row_number().over(W.partitionBy("query_id", "term").orderBy(F.desc("bound"), "least_id", "block"))
    blocks.withColumn("place", place).where(F.col("place") <= FIRST_BLOCKS).write.parquet(f"{path}-first")
    first = hits.sparkSession.read.parquet(f"{path}-first")
    reached = _best(_scores(hits, first, ["tier", "term", "block"], avg_len), k).where(F.col("rank") == k).select(
        "query_id", F.col("score").alias("reached"), F.col("doc_id").alias("reached_id"))
    greatest = blocks.groupBy("query_id", "term").agg(F.max("bound").alias("greatest"))
    together = greatest.groupBy("query_id").agg(F.sum("greatest").alias("together"))
    limits = greatest.join(together, "query_id").join(reached, "query_id", "left")
    # Scores are rounded sums of rounded parts; the bound is a little wider. Of equal scores the smaller doc_id is the better.
    most = F.round(F.col("bound") + F.col("together") - F.col("greatest") + 1e-9, SCORE_DIGITS)
    reach = F.col("reached").isNull() | (most > F.col("reached")) | ((most == F.col("reached")) & (F.col("least_id") <= F.col("reached_id")))
    chosen = f"{path}-chosen"
    blocks.join(limits, ["query_id", "term"]).where(reach).select("query_id", "idf", "tier", "term", "block", "n").write.parquet(chosen)
    return hits.sparkSession.read.parquet(chosen)
