"""Exact token totals for every context limit from one histogram of encoded lengths.

Documents are reduced to (length, number of documents) in the map tasks. Sums over longer lengths then answer, for each length taken as
a limit and for any limit between, how many documents and tokens lie beyond it and what remains after cutting. The sums are taken in
two levels, over ranges of 1024 lengths and inside each, so no task holds all lengths.

Defined results: null and empty texts have length 0; repeated documents count each time; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.bpe import Tokenizer, count_tokens

RANGE = 1024


def length_histogram(docs: DataFrame, tokenizer: Tokenizer, *, text: str = "text") -> DataFrame:
    """n_tokens, docs."""
    return count_tokens(docs, tokenizer, text=text).groupBy("n_tokens").agg(F.count("*").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length as a limit: documents and tokens beyond it, tokens left when cut there, share of documents that fit."""
    h = histogram.withColumn("range", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    ranges = h.groupBy("range").agg(F.sum("docs").alias("range_docs"), F.sum("tokens").alias("range_tokens"))
    later = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("range_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("range_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("range_docs").over(every).alias("all_docs"), F.sum("range_tokens").over(every).alias("all_tokens"),
    )
    longer = Window.partitionBy("range").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    docs = F.col("later_docs") + F.coalesce(F.sum("docs").over(longer), F.lit(0))
    tokens = F.col("later_tokens") + F.coalesce(F.sum("tokens").over(longer), F.lit(0))
    return (
        h.join(ranges, "range").withColumn("docs_longer", docs).withColumn("tokens_longer", tokens)
        .select(
            "n_tokens", "docs", "docs_longer", "tokens_longer",
            (F.col("all_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("tokens_if_cut"),
            ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("share_fitting"),
        )
    )


def totals_at(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """context_limit, tokens_if_cut, docs_longer for limits of any value."""
    each = histogram.select("n_tokens", "docs", F.explode(F.array(*(F.lit(int(x)).cast("long") for x in limits))).alias("context_limit"))
    return each.groupBy("context_limit").agg(
        F.sum(F.least("n_tokens", "context_limit") * F.col("docs")).alias("tokens_if_cut"),
        F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_longer"),
    )


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents do not exceed."""
    return sums.where(F.col("share_fitting") >= share).agg(F.min("n_tokens").alias("n_tokens"))
