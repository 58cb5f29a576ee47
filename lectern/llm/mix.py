"""Mixing sources to target weights by a curriculum that changes over training.

Targets: sources in code-point order (null last) get the weights in turn and share the words of all documents; a target stops
at ``cap`` times its source's words and the excess goes to the others by weight, which is the level of a water-filling over
sources. Each source reads its documents in a fixed pseudo-random order, as often as its target needs; the last document it
reaches is taken in part, so that the words taken are the target, rounded.

Positions: a schedule gives each source's weight as a piecewise linear function of training time. Its integral is the demand up to a time;
inverting it at the number of words a source has handed out gives the time at which a document is read. Documents sorted
by that time are the training order.

The cumulative count does not run over a whole source in one task: each source is cut into 65,536 ranges of the order key, ranges are summed
first, and a window runs inside a range only. The key is a digest of doc_id and text, so rows that share a doc_id are dealt out too. The table of sources has one row per distinct source; it alone is ordered in
one task. Whole rows are shuffled twice: to their range, where the window and the join with the range's offset both find them, and into
training order.

Defined results: null text has size 0; size 0 is never taken; null sources are one source; rows with the same
doc_id are separate documents, each with a place of its own by its text; rows alike in doc_id and text are interchangeable; an empty table gives an empty plan; other columns travel in the struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.runtime import stored

WEIGHTS = (5, 2, 1)
CAP = 3
#: Knots (time, factor) of the schedule that each weight's sources follow; factors are scaled to an integral of 1.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (0.5, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _place(source: Column, range_: Column) -> list[Column]:
    """The range of a source in columns without nulls, on which a window and a join agree; a null-safe join would deal rows out by other keys."""
    return [range_.alias("range"), F.coalesce(source, F.lit("")).alias("name"), source.isNull().alias("unnamed")]


PLACE = ["range", "name", "unnamed"]


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, turn (place in the list of weights), source_size, target: from rows of (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") + 1).cast("int")).cast("long")
    # Sources fill up in order of cap over weight. The level at a source counts those before it as full.
    full = F.col("source_size") * cap
    order = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        per.withColumn("turn", turn)
        .withColumn("weight", weight)
        .withColumn("ratio", full.cast("double") / F.col("weight"))
        .withColumn("left_words", F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left_words").cast("double") / F.col("left_weight"))
    )
    reached = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")),
                       F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(everything)
    target = F.least(full.cast("double"), F.col("reached") * F.col("weight"))
    return ranked.withColumn("reached", reached).select("source", "turn", "source_size", target.alias("target"))


def invert(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the schedule, scaled to 1 at the end, reaches ``share``."""
    areas = [(t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:], strict=False)]
    total, done, out = sum(areas), 0.0, None
    for ((t0, f0), (t1, f1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        need = share * F.lit(total) - F.lit(done)
        slope = (f1 - f0) / (t1 - t0)
        root = F.lit(f0) + F.sqrt(F.greatest(F.lit(f0 * f0) + F.lit(2 * slope) * need, F.lit(0.0)))
        at = F.lit(t0) + F.when(root > 0, F.lit(2.0) * need / root).otherwise(0.0)
        out = at if out is None else F.when(need >= 0, at).otherwise(out)
        done += area
    return F.least(F.greatest(out, F.lit(knots[0][0])), F.lit(knots[-1][0]))


def plan_mix(
    docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, cap: int = CAP, schedules=SCHEDULES, seed: str = ""
) -> DataFrame:
    """doc (struct of all columns), doc_id, size, source_size, target, taken, start (words its source hands out before it), turn."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                         F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    rows = docs.select(
        F.struct("*").alias("doc"), "doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"),
        *_place(F.col("source"), F.conv(F.substring(key, 1, 4), 16, 10).cast("int")),
    )
    # Texts are read once for the sums of (source, range); everything before the last join works on these.
    sums = stored(rows.groupBy("source", "range").agg(F.sum("size").alias("size")), "mix-sums")
    targets = source_targets(sums, weights, cap)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.select("source", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
        .alias("o").join(targets.alias("t"), F.expr("o.source <=> t.source"))
        .select(*_place(F.col("o.source"), F.col("o.range")), "o.offset", "t.turn", "t.source_size", "t.target")
    )
    inside = Window.partitionBy(*PLACE).orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    need = F.floor(F.col("target") + 0.5)
    rest = need - F.floor(need / F.col("source_size")) * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    taken = F.when(F.col("source_size") > 0, F.floor(need / F.col("source_size")) * F.col("size") + part).otherwise(0)
    summed = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return summed.join(offsets, PLACE).withColumn("start", F.col("offset") + F.col("start")).select(
        "doc", "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "start", "turn"
    )


def _time(start: Column, schedules) -> Column:
    share = F.when(F.col("target") > 0, start / F.col("target")).otherwise(0.0)
    out = invert(share, schedules[-1])
    for i, knots in enumerate(schedules[:-1]):
        out = F.when(F.col("turn") == i, invert(share, knots)).otherwise(out)
    return out


def positions(plan: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """The plan with ``position``: the time of a document's first reading, null if it is never read; sorted by it."""
    at = F.when(F.col("taken") > 0, _time(F.col("start").cast("double"), schedules))
    return plan.withColumn("position", F.round(at, 9)).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def realise(plan: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """One row of the documents' columns for each reading, in training order; a part counts as a reading from a half up."""
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    again = F.explode(F.sequence(F.lit(0), (copies - 1).cast("int")))
    start = F.col("start").cast("double") + F.col("copy") * F.col("source_size")
    return (
        plan.where(copies > 0).select("*", again.alias("copy"))
        .withColumn("position", _time(start, schedules))
        .repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
        .select("doc.*")
    )
