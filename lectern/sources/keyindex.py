"""Secondary indexes of the facts: which month holds a key, and which months may hold one.

A fact is partitioned by month and looked up by key. ``KeyIndex`` keeps (key, month) in buckets by key hash, so a batch finds the months it
touches without reading the fact. ``Membership`` keeps blocked filters per month instead, four bytes a key: a key that no filter knows is new,
and only months whose filter knows a key of the batch are read to make sure.

Both are written before the fact. After a crash they may so know of rows that are not there, never the other way round, and a
month named in vain is read in vain. Both are built from the fact where they are missing, or where the fact was replaced behind their back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.sources.segments import Segments
from lectern.sources.store import Lake


def _spread(df: DataFrame) -> DataFrame:
    """Few files per bucket, and a bucket too big for one task in several."""
    return df.hint("rebalance", "bucket")


class KeyIndex:
    def __init__(self, lake: Lake, table: str, key: str, key_type: str = "string", *, buckets: int = 64, fan: int = 4):
        """``buckets`` counts when the index is first built: as many as keep a bucket of the expected keys at a few hundred MB."""
        self.lake, self.table, self.key = lake, table, key
        self.segments = Segments(lake, f"index/{table}/months", fan=fan)
        self.schema = f"{key} {key_type}, part string, bucket int"
        self.buckets = self.segments.info().get("buckets", buckets)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _version(self) -> int:
        return (self.lake.versions(self.table) or [0])[-1]

    def ensure(self, fact: DataFrame) -> bool:
        """Build the index from ``fact`` unless it is there and belongs to the fact's version; says whether it was built."""
        if self.segments.exists() and self.segments.info().get("version") == self._version():
            return False
        self.segments.clear()
        self.add(fact.select(self.key, "part"), "start")
        return True

    def add(self, rows: DataFrame, tag: str) -> None:
        """Note the months of new keys, once for each ``tag``."""
        held = rows.select(self.key, "part").withColumn("bucket", self.bucket())
        self.segments.add(_spread(held), tag, "bucket", info={"buckets": self.buckets, "version": self._version()})
        self.segments.merge(self.schema, lambda df: _spread(df.drop("seg")), "bucket")

    def rows(self, keys: DataFrame) -> DataFrame:
        """What the buckets of ``keys`` hold; at most one number per bucket reaches the driver."""
        touched = [r[0] for r in keys.select(self.bucket().alias("bucket")).distinct().collect()]
        return self.segments.read(self.schema, values=touched).select(self.key, "part")

    def months_of(self, keys: DataFrame) -> DataFrame:
        """``part`` and key of those of ``keys`` that are stored."""
        return self.rows(keys).join(keys.select(self.key), self.key, "left_semi")


#: Words of a filter block, the bits of one, and the keys that a block is made for.
WORDS, WORD_BITS, KEYS_PER_BLOCK = 8, 64, 16


class Membership:
    """Filters of 8 words of 64 bits. A key sets one bit in each word of its block; words are joined by ``bit_or``.

    Made for 16 keys a block, a block knows a key that was never set in about one case of 100,000. A month's blocks are as many as a power of two; each
    addition brings its own, and additions of one month are merged when there are ``fan`` of them, by adding up blocks of equal number.
    """

    def __init__(self, lake: Lake, table: str, key: str, *, fan: int = 4):
        self.lake, self.table, self.key = lake, table, key
        self.segments = Segments(lake, f"index/{table}/filters", fan=fan)
        self.words = [f"w{i}" for i in range(WORDS)]
        self.schema = f"part string, size int, block bigint, {', '.join(f'{w} bigint' for w in self.words)}"

    def _version(self) -> int:
        return (self.lake.versions(self.table) or [0])[-1]

    def _hash(self, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), F.col(self.key))

    def _block(self, size: Column) -> Column:
        """The block's number among 2**size."""
        return F.call_function("shiftrightunsigned", self._hash(1), F.lit(1)).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - 1)

    def _bits(self) -> list[Column]:
        """The bit of each word: six bits of a second hash for each."""
        hashed = self._hash(2)
        place = lambda i: F.call_function("shiftrightunsigned", hashed, F.lit(6 * i)).bitwiseAND(WORD_BITS - 1).cast("int")
        return [F.call_function("shiftleft", F.lit(1).cast("bigint"), place(i)) for i in range(WORDS)]

    def _filters(self, rows: DataFrame) -> DataFrame:
        """The blocks of (key, part) rows. A month's size class comes from its own count; it is one row per month."""
        counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        sizes = counts.select("part", F.greatest(
            F.ceil(F.log2(F.col("n").cast("double") / KEYS_PER_BLOCK)), F.lit(0)).cast("int").alias("size"))
        bits = rows.join(sizes, "part").withColumn("block", self._block(F.col("size"))).withColumns(dict(zip(self.words, self._bits())))
        return bits.groupBy("part", "size", "block").agg(*[F.bit_or(w).alias(w) for w in self.words])

    def ensure(self, fact: DataFrame) -> bool:
        if self.segments.exists() and self.segments.info().get("version") == self._version():
            return False
        self.segments.clear()
        self.add(fact.select(self.key, "part"), "start")
        return True

    def add(self, rows: DataFrame, tag: str) -> None:
        keys = rows.where(F.col(self.key).isNotNull()).select(self.key, "part")
        self.segments.add(self._filters(keys), tag, info={"version": self._version()})
        self.segments.merge(self.schema, self._joined)

    def _joined(self, rows: DataFrame) -> DataFrame:
        """Blocks of equal number and class in one, as long as that holds few keys; a fuller one stays apart."""
        full = reduce(lambda a, b: a + b, [F.bit_count(w) for w in self.words])
        rows = rows.withColumn("full", full > WORDS * KEYS_PER_BLOCK // self.segments.fan)
        apart, few = rows.where("full").drop("full", "seg"), rows.where("NOT full")
        return apart.unionByName(few.groupBy("part", "size", "block").agg(*[F.bit_or(w).alias(w) for w in self.words]))

    def months(self, keys: DataFrame) -> list[str]:
        """The months that may hold one of ``keys``: one name per month reaches the driver.

        A key meets one block of each month; whether its bits are set is part of the join condition, so only hits come out.
        """
        filters = self.segments.read(self.schema).drop("seg")
        classes = F.explode(F.array([F.lit(r[0]) for r in filters.select("size").distinct().collect()] or [F.lit(0)])).alias("size")
        probes = keys.select(self.key).select(classes, *[b.alias(f"b{i}") for i, b in enumerate(self._bits())], self.key)
        probes = probes.withColumn("block", self._block(F.col("size"))).drop(self.key)
        known = F.lit(True)
        for i, w in enumerate(self.words):
            known = known & (F.col(w).bitwiseAND(F.col(f"b{i}")) != 0)
        hits = filters.join(probes.withColumnsRenamed({"size": "s", "block": "b"}), (F.col("size") == F.col("s")) & (F.col("block") == F.col("b")) & known)
        return sorted(r[0] for r in hits.select("part").distinct().collect())
