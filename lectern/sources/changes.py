"""The changes of a table, commit by commit, and how far each consumer has read them.

A merge first stores what it is going to do: the rows before it (``before``), after it (``after``), the new ones (``insert``) and those taken out
(``delete``). Only then it changes the table, and then it publishes the commit. A commit that was stored but not published is what a crash left;
the next merge carries it out again before anything else, so table and log never part. Commits are numbered from 1 without gaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.sources.store import Lake

INSERT, BEFORE, AFTER, DELETE = "insert", "before", "after", "delete"


def sign() -> Column:
    """What a change adds to a count of rows: rows before a change and deleted rows count as -1."""
    return F.when(F.col("change").isin(BEFORE, DELETE), -1).otherwise(1)


class ChangeLog:
    def __init__(self, lake: Lake, table: str, schema: str):
        self.lake, self.schema = lake, schema
        self.base = f"{lake.root}/changes/{table}"

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        return sorted(int(c[len(prefix):]) for c in self.lake._children(folder) if c.startswith(prefix))

    def last(self) -> int:
        """The newest published commit; 0 before the first."""
        return (self._numbers(f"{self.base}/published", "commit-") or [0])[-1]

    def pending(self) -> int | None:
        """A commit that was stored and never published."""
        number = self.last() + 1
        return number if self.lake._exists(f"{self.path(number)}/_SUCCESS") else None

    def path(self, number: int) -> str:
        return f"{self.base}/rows/commit={number}"

    def prepare(self, rows: DataFrame) -> int:
        """Store the rows (with their ``change``) of the next commit."""
        number = self.last() + 1
        rows.write.mode("overwrite").parquet(self.path(number))
        return number

    def publish(self, number: int) -> None:
        self.lake.write_text(f"{self.base}/published/commit-{number:012d}", "")

    def rows(self, number: int) -> DataFrame:
        """The rows of one stored commit."""
        return self.lake.spark.read.schema(f"{self.schema}, change string").parquet(self.path(number))

    def read(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The rows of published commits past ``after``, each with its ``commit``."""
        upto = self.last() if upto is None else upto
        schema = f"{self.schema}, change string, commit int"
        folders = [self.path(n) for n in range(after + 1, upto + 1)]
        if not folders:
            return self.lake.empty(schema)
        return self.lake.spark.read.schema(schema).option("basePath", f"{self.base}/rows").parquet(*folders)

    def net(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The changes with what cancels out left out: a row that came and went, or that was changed and is as before again."""
        rows = self.read(after, upto)
        columns = [c for c in rows.columns if c not in ("change", "commit")]
        counted = rows.groupBy(*columns).agg(F.sum(sign()).alias("n")).where("n <> 0")
        return counted.select(*columns, F.col("n").cast("int").alias("n"))


class Consumer:
    """A reader that handles each commit of some tables once; its position moves only when the handler is done."""

    def __init__(self, lake: Lake, name: str):
        self.lake, self.base = lake, f"{lake.root}/changes/_consumers/{name}"

    def position(self, table: str) -> int:
        seen = [int(c[5:]) for c in self.lake._children(f"{self.base}/{table}") if c.startswith("upto-")]
        return max(seen, default=0)

    def run(self, logs: dict[str, ChangeLog], handle: Callable[[dict[str, tuple[int, int]]], None]) -> bool:
        """Give ``handle`` the span (after, upto) of each table that has news; says whether there were any.

        A handler that fails, or whose process ends before its position is noted, gets the same span again, or a longer one.
        """
        spans = {t: (self.position(t), log.last()) for t, log in logs.items()}
        news = {t: s for t, s in spans.items() if s[1] > s[0]}
        if not news:
            return False
        handle(news)
        for table, (_, upto) in news.items():
            self.move(table, upto)
        return True

    def move(self, table: str, upto: int) -> None:
        if upto > self.position(table):
            self.lake.write_text(f"{self.base}/{table}/upto-{upto:012d}", "")
