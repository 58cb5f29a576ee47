"""A manifest of a data set as Merkle trees: one per group, and one over the groups' roots.

Leaves have to lie in order of doc_id. Their places come without sorting them: each group has a bitmap of its doc_ids, kept as those words of 64
bits that have members, with directories of counts over 16 bits of the id at a time. The place of a leaf is the count before its word plus the set bits below its
own. Places are keys from then on: eight places make a run, an array keyed by slot, whose digest is the node at an eighth of the place; the
levels shrink eightfold until one node per group is left. Proofs are handed down from the root: what a run has to show besides a node is read
off its array, so a leaf meets its proof where its run is opened, and no proof of a leaf is shuffled.

Each list of the directory covers at most 65,536 entries. Rows that share a doc_id count in their bit's word; they are ordered by leaf, through counts by
the first two bytes of it, and equal rows are expanded from their count, so a doc_id with a third of all rows is split. One row per group is
ordered in one task; nothing else is.

Defined results: a null column enters a leaf as ``-``; null doc_ids come first in their group and are never tampered with; repeated doc_ids are ordered by
leaf; equal rows have equal leaves and a place each; null is a group of its own, before all others; an empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.runtime import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a run, and bytes of a digest.
FAN, DIGEST = 8, 32
#: Bits of a doc_id in a word, and bits of a word's number that a directory takes at a time.
WORD_BITS, LIST_BITS = 6, 16
#: Copies of a row that are expanded at a time.
COPIES = 65_536
#: The word of rows without doc_id: smaller than any other, at every level of the directory.
NO_ID = -(1 << 57) - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(column: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaves(docs: DataFrame) -> DataFrame:
    """``grp`` (sorts as lang does, null first), ``doc_id``, ``leaf`` and, where a row is to be tampered with, its ``altered`` leaf."""
    def digest(text: Column) -> Column:
        return _digest(F.concat(*[field(text if c == "text" else F.col(c)) for c in COLUMNS]))

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("v"), "lang"), F.lit("")).alias("grp"), "doc_id", digest(F.col("text")).alias("leaf"),
        F.when(tampered, digest(F.translate("text", UPPER, LOWER))).alias("altered"),
    )


def _with_word(df: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    return df.withColumns({
        "word": F.coalesce(F.shiftright(doc_id, WORD_BITS), F.lit(NO_ID)),
        "bit": F.coalesce(doc_id.bitwiseAND((1 << WORD_BITS) - 1), F.lit(0)).cast("int"),
    })


def bitmaps(rows: DataFrame) -> DataFrame:
    """One row per group and word with members: its bits, the rows before it in the group, and the depth of the group's tree.

    ``more`` lists the bits that stand for several rows, with the number of rows beyond the first.
    """
    per_bit = _with_word(rows).groupBy("grp", "word", "bit").agg(F.count(F.lit(1)).alias("n"))
    words = stored(per_bit.groupBy("grp", "word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("bits"), F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("beyond")))).alias("more"),
    ), "bitmaps")
    out = words.withColumn("base", F.lit(0).cast("bigint"))
    level, sums = "word", words.select("grp", "word", "n")
    for up in ("list1", "list2", "list3", None):
        if up:
            parent = F.shiftright(level, LIST_BITS)
            sums, out = sums.withColumn(up, parent), out.withColumn(up, F.shiftright(level, LIST_BITS))
        inside = W.partitionBy("grp", *([up] if up else [])).orderBy(level).rowsBetween(W.unboundedPreceding, -1)
        before = sums.select("grp", level, F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("before"))
        out = out.join(before, ["grp", level]).withColumn("base", F.col("base") + F.col("before")).drop("before")
        level, sums = up, sums.groupBy("grp", *([up] if up else [])).agg(F.sum("n").alias("n"))
    depth = reduce(lambda a, b: a + b, [(F.col("size") > FAN**k).cast("int") for k in range(21)])
    sizes = sums.select("grp", F.col("n").alias("size")).withColumn("depth", depth)
    return out.join(sizes, "grp").select("grp", "word", "bits", "more", "base", "depth")


def coordinates(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The rows with the ``place`` of each in its group, and the group's depth."""
    bit = F.col("bit")
    below = F.when(bit == 0, 0).otherwise(F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), 64 - bit))
    beyond = lambda keep: F.aggregate(
        F.filter("more", keep), F.lit(0).cast("bigint"), lambda total, m: total + m["beyond"])
    placed = stored(_with_word(rows).join(words, ["grp", "word"]).select(
        "grp", "depth", "doc_id", "leaf", "altered",
        (F.col("base") + F.bit_count(F.col("bits").bitwiseAND(below)) + beyond(lambda m: m["bit"] < bit)).alias("place"),
        (beyond(lambda m: m["bit"] == bit) > 0).alias("shared"),
    ), "places")
    kept = ["grp", "depth", "doc_id", "leaf", "altered", "place"]
    return placed.where("NOT shared").select(*kept).unionByName(_spread(placed.where("shared")).select(*kept))


def _spread(rows: DataFrame) -> DataFrame:
    """A place of its own for each row of one doc_id, in order of leaf."""
    same = rows.groupBy("grp", "depth", "doc_id", "place", "leaf", "altered").agg(F.count(F.lit(1)).alias("n"))
    same = same.withColumn("part", F.substring("leaf", 1, 2))
    one = ["grp", "place"]
    earlier = lambda order, *keys: F.coalesce(F.sum("n").over(
        W.partitionBy(*one, *keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = same.groupBy(*one, "part").agg(F.sum("n").alias("n")).select(*one, "part", earlier("part").alias("before"))
    start = F.col("place") + F.col("before") + F.col("within")
    found = same.withColumn("within", earlier("leaf", "part")).join(parts, [*one, "part"]).withColumn("place", start)
    whole = found.withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES).cast("bigint"))))
    last = F.least(F.col("first") + COPIES, F.col("n")) - 1
    return whole.withColumn("i", F.explode(F.sequence(F.col("first"), last))).withColumn("place", F.col("place") + F.col("i"))


def _runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """Runs of eight nodes: their digests joined in order of slot, and what else the nodes carry in that order."""
    slot = F.col("place").bitwiseAND(FAN - 1).alias("slot")
    slots = F.sort_array(F.collect_list(F.struct(slot, "digest", *carried)))
    runs = nodes.groupBy("grp", "depth", F.shiftright("place", 3).alias("place")).agg(slots.alias("slots"))
    joined = F.unhex(F.array_join(F.transform("slots", lambda s: F.hex(s["digest"])), ""))
    runs = runs.withColumn("joined", joined).withColumn("digest", _digest(_hex(F.col("joined"))))
    return runs if carried else runs.drop("slots")


def reduce_levels(nodes: DataFrame, *carried: str) -> list[DataFrame]:
    """The runs of each level, from the leaves up, each stored: as many as the deepest group has."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels = []
    for k in range(deepest):
        runs = _runs(nodes.where(F.col("depth") > k), *(carried if k == 0 else ()))
        levels.append(stored(runs, f"level-{k}"))
        nodes = levels[-1].select("grp", "depth", "place", "digest")
    return levels


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The last node of each group."""
    found = [nodes.where("depth = 0").select("grp", "digest")]
    found += [runs.where(F.col("depth") == k + 1).select("grp", "digest") for k, runs in enumerate(levels)]
    return reduce(DataFrame.unionByName, found)


def _opened(runs: DataFrame, above: DataFrame, *carried: Column) -> DataFrame:
    """The nodes of the runs, each with its siblings (``left``, ``right``) before those of the levels above."""
    at = F.col("slot") * DIGEST
    found = runs.join(above, ["grp", "place"]).withColumn(
        "slot", F.explode(F.sequence(F.lit(0), (F.octet_length("joined") / DIGEST).cast("int") - 1)))
    here = F.struct(F.expr("substring(joined, 1, slot * 32)").alias("left"), F.expr("substring(joined, slot * 32 + 33)").alias("right"))
    return found.select(
        "grp", (F.col("place") * FAN + F.col("slot")).alias("place"), F.concat(F.array(here), "siblings").alias("siblings"), *carried)


def _handed_down(levels: list[DataFrame], tops: DataFrame, *carried: Column) -> DataFrame:
    """The siblings of every node of the lowest level; ``tops`` has those of each group's last node."""
    above = None
    for k in reversed(range(len(levels))):
        roots = levels[k].where(F.col("depth") == k + 1).select("grp", "place").join(tops.select("grp", "siblings"), "grp")
        above = roots if above is None else above.unionByName(roots)
        above = _opened(levels[k], above, *(carried if k == 0 else ()))
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs`` (which has ``COLUMNS``)."""
    rows = stored(leaves(docs), "leaves")
    nodes = coordinates(rows, stored(bitmaps(rows), "words")).withColumnRenamed("leaf", "digest")
    nodes = stored(nodes, "nodes")
    levels = reduce_levels(nodes, "doc_id", "altered")
    subroots = stored(_tops(nodes, levels), "subroots")

    # One row per group, in order.
    size = subroots.agg(F.count(F.lit(1))).first()[0]
    depth = sum(size > FAN**k for k in range(21))
    ordered = stored(subroots.select(
        F.lit("").alias("grp"), F.lit(depth).alias("depth"), (F.row_number().over(W.orderBy("grp")) - 1).cast("bigint").alias("place"),
        "digest", F.col("grp").alias("inner")), "groups")
    upper = reduce_levels(ordered, "inner")
    root = _tops(ordered, upper).select(_hex(F.col("digest"))).first()
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    start = ordered.select("grp").distinct().withColumn("siblings", none)
    if upper:
        groups = _handed_down(upper, start, F.expr("slots[slot].inner").alias("inner")).select(F.col("inner").alias("grp"), "siblings")
    else:
        groups = ordered.select(F.col("inner").alias("grp"), none.alias("siblings"))
    groups = stored(groups, "group-proofs")

    alone = nodes.where("depth = 0").join(groups, "grp").select("grp", "doc_id", "digest", "altered", "siblings")
    if levels:
        entry = F.expr("slots[slot]").alias("e")
        found = _handed_down(levels, groups, entry).select("grp", "e.doc_id", "e.digest", "e.altered", "siblings").unionByName(alone)
    else:
        found = alone
    folded = F.aggregate(
        "siblings", _hex(F.coalesce("altered", "digest")),
        lambda node, s: F.sha2(F.concat(_hex(s["left"]), node, _hex(s["right"])), 256))
    shown = F.array_join(F.transform("siblings", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    return (
        found.join(subroots.select("grp", F.col("digest").alias("top")), "grp").select(
            "doc_id", _hex(F.col("digest")).alias("leaf"), _hex(F.col("top")).alias("subroot"),
            F.lit(root[0] if root else None).cast("string").alias("root"), F.sha2(shown, 256).alias("proof_sha256"), folded.alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
