"""A table as a list of Parquet folders that grows by small ones and is merged level by level.

A folder counts once a list names it. Lists are small numbered files, moved into place as a whole, and the newest one is current: a
reader sees all of an addition or nothing. ``fan`` folders of one level are merged into one of the next, so a row is rewritten once per level,
and about ``fan`` folders a level are live. Folders that were merged stay for one more list, for readers of the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lectern.sources.store import Lake


@dataclass(frozen=True)
class Segment:
    name: str
    level: int
    tag: str


class Segments:
    def __init__(self, lake: Lake, name: str, *, fan: int = 4):
        if fan < 2:
            raise ValueError("at least two folders are merged at a time")
        self.lake, self.fan = lake, fan
        self.base = f"{lake.root}/{name}"

    def _newest(self) -> dict:
        lists = [c for c in self.lake._children(f"{self.base}/lists") if c.endswith(".json")]
        found = json.loads(self.lake.read_text(f"{self.base}/lists/{lists[-1]}")) if lists else {}
        return {"number": 0, "live": [], "gone": [], "info": {}} | found

    def _commit(self, state: dict, live: list[Segment], gone: Iterable[str] = (), info: dict | None = None) -> None:
        gone = list(gone)
        for name in set(state["gone"]) - set(gone):
            self.lake.remove(self._folder(name))
        number = state["number"] + 1
        text = json.dumps({"number": number, "live": [[s.name, s.level, s.tag] for s in live], "gone": gone,
                           "info": state["info"] | (info or {})})
        self.lake.write_text(f"{self.base}/lists/{number:012d}.json", text)
        # The list before stays for readers that are about to open it.
        self.lake.remove(f"{self.base}/lists/{number - 2:012d}.json")

    def _folder(self, name: str) -> str:
        return f"{self.base}/segments/seg={name}"

    def live(self) -> list[Segment]:
        """The folders that count, oldest first."""
        return [Segment(*s) for s in self._newest()["live"]]

    def info(self) -> dict:
        """What the writers noted in the newest list."""
        return self._newest()["info"]

    def exists(self) -> bool:
        return self._newest()["number"] > 0

    def read(self, schema: str, *, segments: Iterable[Segment] | None = None, column: str = "bucket",
             values: Iterable[int] | None = None) -> DataFrame:
        """All rows with their ``seg``; ``values`` reads only those folders of the partition ``column``."""
        folders = [self._folder(s.name) for s in (self.live() if segments is None else segments)]
        if values is not None:
            wanted = {f"{column}={v}" for v in values}
            folders = [f"{f}/{c}" for f in folders for c in self.lake._children(f) if c in wanted]
        schema = f"{schema}, seg string"
        if not folders:
            return self.lake.empty(schema)
        return self.lake.spark.read.schema(schema).option("basePath", f"{self.base}/segments").parquet(*folders)

    def add(self, df: DataFrame, tag: str, *partition_by: str, info: dict | None = None) -> None:
        """One more folder; an earlier addition of the same ``tag`` that was not merged yet is replaced."""
        self.name(self.write(df, tag, *partition_by), info=info)

    def write(self, df: DataFrame, tag: str, *partition_by: str) -> Segment:
        """Store a folder that does not count before ``name`` lists it."""
        name = f"{tag}-{uuid.uuid4().hex[:8]}"
        df.write.partitionBy(*partition_by).parquet(self._folder(name))
        return Segment(name, 0, tag)

    def name(self, segment: Segment, *, info: dict | None = None) -> None:
        """List a stored folder."""
        tag = segment.tag
        state = self._newest()
        old = [Segment(*s) for s in state["live"]]
        live = [s for s in old if s.level > 0 or s.tag != tag] + [segment]
        self._commit(state, live, [s.name for s in old if s not in live], info)

    def merge(self, schema: str, combine: Callable[[DataFrame], DataFrame], *partition_by: str) -> int:
        """Merge full levels, from the lowest up; returns the number of merges. ``combine`` gets the rows of a level with their ``seg``."""
        merges = 0
        while True:
            live = self.live()
            full = [n for n in {s.level for s in live} if sum(s.level == n for s in live) >= self.fan]
            if not full:
                return merges
            level = min(full)
            taken = [s for s in live if s.level == level]
            name = f"merged-{uuid.uuid4().hex[:8]}"
            combine(self.read(schema, segments=taken)).write.partitionBy(*partition_by).parquet(self._folder(name))
            state = self._newest()
            at = live.index(taken[-1])
            merged = [s for s in live[:at] if s not in taken] + [Segment(name, level + 1, taken[-1].tag)] + live[at + 1:]
            self._commit(state, merged, [s.name for s in taken])
            merges += 1

    def note(self, **info) -> None:
        """Note what the next list is to say, unless it is said already."""
        state = self._newest()
        if state["info"] | info != state["info"]:
            self._commit(state, [Segment(*s) for s in state["live"]], state["gone"], info)

    def clear(self) -> None:
        self.lake.remove(self.base)
