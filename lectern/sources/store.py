"""Parquet tables under one root, replaced as a whole, by partition, or appended to.

``<root>/<table>/v=<n>`` holds a version, and the newest one with a ``_SUCCESS`` marker is current.
A job can so read a table while ``replace`` writes its next version, and a failed ``replace`` leaves it
as it was. ``append`` and ``replace_partitions`` change the current version in place: their files appear
when the job commits, and what they write belongs to partitions that a rerun overwrites.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _children(self, path: str) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p))

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def remove(self, path: str) -> None:
        """Delete a folder that nothing reads any more."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def read_text(self, path: str) -> str:
        """A small file as text."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file that appears as a whole, or fail if it is there already."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        part = self.spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        stream = fs.create(part)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(p) or not fs.rename(part, p):
            fs.delete(part, False)
            raise FileExistsError(path)

    def drop_old_versions(self, table: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` versions, and return those deleted.

        Keep as many as the longest-running reader may still hold.
        """
        if keep < 1:
            raise ValueError("the current version must be kept")
        old = self.versions(table)[:-keep]
        for n in old:
            self.remove(self.path(table, n))
        return old

    def versions(self, table: str) -> list[int]:
        """Finished versions, oldest first."""
        base = f"{self.root}/{table}"
        found = [int(c[2:]) for c in self._children(base) if c.startswith("v=")]
        return sorted(n for n in found if self._exists(f"{base}/v={n}/_SUCCESS"))

    def path(self, table: str, version: int | None = None) -> str:
        if version is None:
            version = (self.versions(table) or [0])[-1]
        return f"{self.root}/{table}/v={version}"

    def empty(self, schema: str) -> DataFrame:
        """No rows, in a form that the optimizer knows to be empty, so that a join with it is left out."""
        return self.spark.createDataFrame([], schema).limit(0)

    def read(self, table: str, schema: str, parts: Iterable[str] | None = None, part_col: str = "part") -> DataFrame:
        """The current version, or an empty frame; ``parts`` reads only those partition folders."""
        if not self.versions(table):
            return self.empty(schema)
        path = self.path(table)
        reader = self.spark.read.schema(schema)
        if parts is None:
            return reader.parquet(path)
        folders = [f"{path}/{part_col}={p}" for p in parts]
        if not folders:
            return self.empty(schema)
        return reader.option("basePath", path).parquet(*folders)

    def replace(self, table: str, df: DataFrame, *partition_by: str) -> None:
        """Write the next version; readers move over once it is complete."""
        numbers = [int(c[2:]) for c in self._children(f"{self.root}/{table}") if c.startswith("v=")]
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(table, max(numbers, default=0) + 1))

    def append(self, table: str, df: DataFrame, *partition_by: str) -> None:
        if not self.versions(table):
            self.replace(table, df, *partition_by)
        else:
            df.write.mode("append").partitionBy(*partition_by).parquet(self.path(table))

    def replace_partitions(self, table: str, df: DataFrame, *partition_by: str) -> None:
        """Overwrite only the partitions present in ``df``; it may have been read from this table."""
        if not self.versions(table):
            self.replace(table, df, *partition_by)
        else:
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *partition_by
            ).parquet(self.path(table))

    def drop_partition(self, table: str, *folders: str) -> None:
        """Delete one partition (``column=value`` folders) of the current version, if it is there."""
        if self.versions(table):
            self.remove("/".join([self.path(table), *folders]))

    def drop_all_old_versions(self, keep: int = 2) -> None:
        """Old versions of every table below the root."""
        for area in self._children(self.root):
            for name in self._children(f"{self.root}/{area}"):
                self.drop_old_versions(f"{area}/{name}", keep)

    def partitions(self, table: str, column: str, *inside: str) -> list[str]:
        """Partition values of the current version, or below its folders ``inside``, from the folder names."""
        if not self.versions(table):
            return []
        children = self._children("/".join([self.path(table), *inside]))
        return [c.split("=", 1)[1] for c in children if c.startswith(f"{column}=")]
