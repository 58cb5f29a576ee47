"""URL filters by a cascade of Bloom filters: exact membership of every key the corpus can ask for, without a join.

A key is a host suffix followed by a path prefix. Only pairs of (number of host labels, length of the path) that some
rule has are ever asked for, so the key universe of a corpus is finite and known: the distinct keys of its urls. Level 0
encodes the listed keys, level 1 the unlisted keys of the universe that pass level 0, level 2 the listed keys that pass
level 1, and so on until nothing passes wrongly. The depth at which a key first fails decides, and it decides rightly for every
key of the universe.

The filters grow with the list of rules, not with the corpus: level 0 has a false positive rate of about
``|listed| / |universe|``, so later levels encode about as many keys as there are rules. Lists are therefore a parameter that the
driver holds.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; an empty path fits only
rules with an empty path; repeated rows each get their verdict; other columns pass through as they are. Of several fitting rules the
longest wins, then the one with the longer host.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.runtime import stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        return self.host.count(".") + 1, len(self.path)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words, hash count, and the seed that sets it apart from other levels."""

    words: tuple[int, ...]
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        # A constant text folds to one array literal; a literal for each word would make the plan as wide as the filter.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        bits = 64 * len(self.words)
        out = F.lit(True)
        for i in range(self.hashes):
            at = _position(key, self.seed, i, bits)
            out = out & (F.getbit(F.element_at(words, (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1)
        return out


def _position(key: Column, seed: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits))


def bloom(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A filter over ``keys`` (column ``key``, about ``n`` rows) with false positive rate ``rate``."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = 64 * max(1, math.ceil(1.45 * n * math.log2(1 / rate) / 64))
    at = F.explode(F.array(*(_position(F.col("key"), seed, i, bits) for i in range(hashes))))
    rows = (
        keys.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        .collect()  # at most bits / 64 rows, set by the length of the list
    )
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["bits"]
    return Level(tuple(words), hashes, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, *, seed: int = 0) -> list[Level]:
    """Levels that tell ``listed`` from the rest of ``universe`` (both with distinct ``key``) without error."""
    n, all_keys = listed.count(), universe.count()
    if not n:
        return []
    rate = min(0.5, max(1e-9, math.sqrt(0.5) * n / max(1, all_keys)))
    levels = [bloom(listed, n, rate, seed)]
    inside = listed
    outside = stored(universe.where(levels[0].passes(F.col("key"))).join(listed, "key", "left_anti"), "cascade")
    while (wrong := outside.count()) > 0:
        levels.append(bloom(outside, wrong, 0.5, seed + len(levels)))
        # What of the other side passes the newest level is what the next one must encode.
        inside, outside = outside, stored(inside.where(levels[-1].passes(F.col("key"))), "cascade")
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: it is if the first level that it fails has an odd number, or the last is even."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(~levels[i].passes(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys a url can ask for: one for each shape it is long enough for."""
    keys = [
        F.when((F.length(path) >= p) & (host != ""), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, p)))
        for n, p in shapes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def filter_urls(pages: DataFrame, rules: list[Rule], *, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages`` in a struct ``row``, with host, path, rule and verdict beside it."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    shapes = sorted({r.shape for r in rules})
    parts = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    asked = parts.select(F.explode(candidate_keys(F.col("host"), F.col("path"), shapes)).alias("key")).distinct()
    universe = stored(asked, "url-keys")
    verdicts = sorted({r.verdict for r in rules})
    cascades = {v: build_cascade(_keys(spark, [r for r in rules if r.verdict == v]), universe) for v in verdicts}

    def judged(key: Column) -> Column:
        verdict = F.lit(None).cast("string")
        for v in verdicts:
            verdict = F.when(member(cascades[v], key), F.lit(v)).otherwise(verdict)
        # Longest first; of equal length, the one with the shorter path and so the longer host.
        return F.struct(F.length(key).alias("length"), (-F.length(F.substring_index(key, "/", 1))).alias("host"),
                        key.alias("rule"), verdict.alias("verdict"))

    fits = F.filter(F.transform(candidate_keys(F.col("host"), F.col("path"), shapes), judged), lambda x: x["verdict"].isNotNull())
    best = F.array_sort(fits, lambda a, b: F.when(a["length"] != b["length"], b["length"] - a["length"]).otherwise(a["host"] - b["host"]))
    won = F.get(best, F.lit(0))
    return parts.select(
        "row", "host", "path", won["rule"].alias("rule"), F.coalesce(won["verdict"], F.lit(default)).alias("verdict")
    )


def _keys(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    keys = sorted({r.key for r in rules})
    packed = spark.range(1).select(F.explode(F.split(F.lit("\n".join(keys)), "\n")).alias("key"))
    return packed.where("key != ''")
