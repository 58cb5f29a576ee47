"""What each filter of a pipeline removes in every order, from packed counters.

A document is known by its mask: one bit for each filter that it fails. Every mask has one big integer of 64-bit fields, six for
each step of each order (600 steps of five filters): whether such a document is kept after the step, removed at it, and so on. The integers of a
part's documents are added up, n equal ones at a time, and the sum is unpacked. A field is at most the number of the
part's documents, below 2**63, so no field runs over into the next. The sum does not depend on order, and a part has at most 2**k * 4 different integers
however many documents it has: documents are counted by mask before they are shuffled.

Defined results: null text is empty; null and empty parts are one part, the empty string; a null doc_id is no smaller than any and has none smaller,
so it is never a copy; rows with equal doc_id and text are no copies of each other, and each counts; a document is good (toxic) if any label row
of its doc_id says 1, and neither where it has none; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import cache, partial
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.runtime import ship

LETTERS = "ABCDE"
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{f} bigint" for f in FIELDS) + ", shapley bigint"
WORDS, DISTINCT, CAPITALS, MARKS = 100, 80, 10, r"[#$%&*|]"


@cache
def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def outcomes(mask: int, good: bool, toxic: bool, letters: str = LETTERS) -> np.ndarray:
    """One 0 or 1 for each order, step and field."""
    fails = np.array([[bool(mask >> letters.index(x) & 1) for x in order] for order in orders(letters)])
    gone = np.cumsum(fails, axis=1) > 0
    before = np.c_[np.zeros(len(fails), bool), gone[:, :-1]]
    removed = fails & ~before
    return np.stack([~gone, removed, fails & before, fails & (mask.bit_count() == 1), removed & good, removed & toxic], axis=2)


@cache
def packed(mask: int, good: bool, toxic: bool, letters: str = LETTERS) -> int:
    """The outcomes as one integer of 64-bit fields."""
    return int.from_bytes(outcomes(mask, good, toxic, letters).astype("<u8").tobytes(), "little")


def unpack(total: int, letters: str = LETTERS) -> np.ndarray:
    shape = (len(orders(letters)), len(letters), len(FIELDS))
    data = total.to_bytes(8 * int(np.prod(shape)), "little")
    return np.frombuffer(data, "<u8").astype(np.int64).reshape(shape)


def _part_rows(letters: str, counts: pd.DataFrame) -> pd.DataFrame:
    """All steps of one part; ``counts`` has at most 4 rows for each mask."""
    rows = zip(counts["mask"].tolist(), counts["good"].tolist(), counts["toxic"].tolist(), counts["n"].tolist())
    total = sum(n * packed(mask, good, toxic, letters) for mask, good, toxic, n in rows)
    fields = unpack(total, letters)
    steps = [(order, step) for order in orders(letters) for step in range(1, len(letters) + 1)]
    out = pd.DataFrame({"part": counts["part"].iloc[0], "filter_order": [o for o, _ in steps], "step": [s for _, s in steps]})
    for i, name in enumerate(FIELDS):
        out[name] = fields[:, :, i].ravel()
    out["shapley"] = out.groupby([order[step - 1] for order, step in steps])["removed"].transform("sum")
    return out


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step from ``counts``: part, mask, good, toxic and n, one row for each combination."""
    ship(counts.sparkSession)
    return counts.groupBy("part").applyInPandas(partial(_part_rows, letters), SCHEMA)


def text_failures(text) -> list:
    """The filters that need the text alone, in letter order: too few words, repeated words, capitals, marks."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [n < WORDS, 100 * distinct < DISTINCT * n, 100 * capitals > CAPITALS * F.length(text), text.rlike(MARKS)]


def count_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents counted by part, mask, good and toxic.

    ``docs`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic. Whether a text has a copy of smaller doc_id follows from
    counts per text: rows of a text are counted by doc_id and by what else is known of them, so a text or a doc_id with a third of all rows is counted
    before it is shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(text))]
    mask = bits[0] + bits[1] + bits[2] + bits[3]
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = rows.join(marks, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    kind = ["digest", "part", "mask", "good", "toxic"]
    per_id = known.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    per_kind = per_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"))
    # A text has few kinds of rows, whatever the number of its copies.
    first = F.min("least").over(W.partitionBy("digest"))
    alone = F.col("without_id") + F.when(F.col("least") == first, F.col("at_least")).otherwise(0)
    split = per_kind.withColumn("alone", alone).select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("alone").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("alone")).alias("n")),
    )).alias("e"))
    return split.where("e.n > 0").groupBy("part", F.col("e.mask").alias("mask"), "good", "toxic").agg(F.sum("e.n").alias("n"))
