"""Constraint counts that follow the change logs.

For each value of each key the state holds how many rows use it in each role: as the key of its own table, and as the key that another table
refers to. A batch adds signed counts of its own changes. Only the values among them are judged, as they were and as they are now, and the
difference goes to the violations of each check, so a late dimension row clears its orphans and a removed one makes them. State lies in buckets by value,
of which only the touched ones are read; folders are merged level by level. Counts, violations and the commits that they include are named
by one list, so a refresh that is repeated after a crash counts nothing twice.

Defined results: null keys are NOT_NULL violations (of a key) or nothing (of a reference); empty tables give zeros; repeated rows count each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans import jobs
from lectern.schemas import ENTITIES
from lectern.sources.changes import sign
from lectern.sources.segments import Segments
from lectern.sources.store import Lake

REPORT_SCHEMA = "table_name string, column_name string, constraint_type string, violations bigint"
#: (table with the column, column, table whose key it is): all keys first, then all references.
ROLES = [(name, spec.key, name) for name, spec in ENTITIES.items()] + [
    (name, natural, dim) for name, spec in ENTITIES.items() for dim, natural in spec.lookups.values()]
COUNTS = [f"n{i}" for i in range(len(ROLES))]
STATE_SCHEMA = "domain string, value string, " + ", ".join(f"{n} bigint" for n in COUNTS) + ", bucket int"


def _checks(n: list[Column]) -> list[tuple[str, str, str, Column]]:
    """Each check with the violations that one value brings, given its count in each role."""
    given, out = F.col("value").isNotNull(), []
    for i, (name, column, domain) in enumerate(ROLES):
        spec = ENTITIES[name]
        if i < len(ENTITIES):
            out.append((spec.table, column, "NOT_NULL", F.when(~given, n[i])))
            out.append((spec.table, column, "UNIQUE", F.when(given & (n[i] > 1), 1)))
        else:
            fk = next(f for f, ref in spec.lookups.items() if ref == (domain, column))
            key = list(ENTITIES).index(domain)
            out.append((spec.table, fk, "FOREIGN_KEY", F.when(given & (n[key] == 0), n[i])))
    return out


class Constraints:
    """Constraint counts of one lake. ``buckets`` counts when the state is first built."""

    def __init__(self, lake: Lake, *, buckets: int = 64, fan: int = 4):
        self.lake = lake
        self.held = Segments(lake, "constraints/uses", fan=fan)
        self.buckets = self.held.info().get("buckets", buckets)
        self.logs = {e: jobs.change_log(lake, e) for e in ENTITIES}

    def _uses(self, entity: str, rows: DataFrame) -> DataFrame:
        """domain, value, role and sign of each key that logged rows hold."""
        held = [
            F.struct(F.lit(i).alias("role"), F.lit(domain).alias("domain"), F.col(column).cast("string").alias("value"))
            for i, (name, column, domain) in enumerate(ROLES) if name == entity
        ]
        return rows.select(sign().alias("sign"), F.explode(F.array(*held)).alias("v")).select("sign", "v.*")

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("domain", "value").agg(*[F.sum(n).alias(n) for n in COUNTS])

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        some = reduce(lambda a, b: a | b, [F.col(n) != 0 for n in COUNTS])
        bucket = F.pmod(F.xxhash64("domain", "value"), F.lit(self.buckets)).cast("int")
        return rows.where(some).withColumn("bucket", bucket).hint("rebalance", "bucket")

    def refresh(self) -> None:
        """Bring counts and violations up to the newest commits; the first time, from the tables."""
        for entity in ENTITIES:
            jobs.recover(self.lake, entity)
        info, ends = self.held.info(), {e: log.last() for e, log in self.logs.items()}
        seen = info.get("upto", {})
        news = [e for e in ENTITIES if not self.held.exists() or ends[e] > seen[e]]
        if not news:
            return
        rows = [
            self._uses(e, self.logs[e].read(seen[e], ends[e]) if seen else jobs.curated(self.lake, e).withColumn("change", F.lit("insert")))
            for e in news
        ]
        delta = reduce(DataFrame.unionByName, rows).groupBy("domain", "value").agg(
            *[F.coalesce(F.sum(F.when(F.col("role") == i, F.col("sign"))), F.lit(0)).alias(n) for i, n in enumerate(COUNTS)])
        # Counts of the news are stored first; they do not count until the list names them.
        segment = self.held.write(self._bucketed(delta), "upto-" + "-".join(map(str, ends.values())), "bucket")
        stored = self.held.read(STATE_SCHEMA, segments=[segment]).drop("seg")
        # At most one number per bucket.
        buckets = [r[0] for r in stored.select("bucket").distinct().collect()]
        old = self.held.read(STATE_SCHEMA, values=buckets).select("domain", "value", *[F.col(n).alias(f"old_{n}") for n in COUNTS])
        held = old.groupBy("domain", "value").agg(*[F.sum(f"old_{n}").alias(f"old_{n}") for n in COUNTS]).withColumnRenamed("value", "of")
        both = stored.join(held.withColumnRenamed("domain", "in"), (F.col("domain") == F.col("in")) & F.col("value").eqNullSafe(F.col("of")), "left")
        before = [F.coalesce(f"old_{n}", F.lit(0)) for n in COUNTS]
        after = [b + F.col(n) for b, n in zip(before, COUNTS, strict=True)]
        moved = both.agg(*[
            F.coalesce(F.sum(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))), F.lit(0)).cast("long").alias(f"c{i}")
            for i, ((*_, b), (*_, a)) in enumerate(zip(_checks(before), _checks(after), strict=True))
        ]).first()
        total = [a + b for a, b in zip(info.get("violations", [0] * len(moved)), moved, strict=True)]
        self.held.name(segment, info={"upto": ends, "buckets": self.buckets, "violations": total})
        self.held.merge(STATE_SCHEMA, lambda df: self._bucketed(self._added(df)), "bucket")

    def report(self) -> DataFrame:
        """The violations of each check as of the last refresh, as ``constraint_report`` counts them from whole tables."""
        rows = [(t, c, k, n) for (t, c, k, _), n in zip(_checks([F.col(n) for n in COUNTS]), self.held.info()["violations"], strict=True)]
        return self.lake.spark.createDataFrame(rows, REPORT_SCHEMA)
