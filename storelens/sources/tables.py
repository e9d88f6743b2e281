"""Tables on plain parquet: append-only tables keyed by batch, and snapshot tables.

Nothing is updated in place. An append is one directory per batch, written with overwrite, so a
batch that is run again replaces itself. A snapshot table writes a new directory and readers take
the newest complete one (its ``_SUCCESS`` marker appears after the last file).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, name: str) -> bool:
        fs, p = self._fs(self.path(name))
        return fs.exists(p)

    # append-only -------------------------------------------------------------------------------

    def append(self, name: str, df: DataFrame, batch_id: str, partition_by: tuple[str, ...] = ()) -> None:
        """Write one batch. Repeating a batch replaces all it wrote before, whatever partitions that had."""
        writer = df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path(name)}/batch_id={batch_id}")

    def files(self, name: str, batch_id: str) -> DataFrame:
        """(path, bytes) of the files of one batch, from their listing."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        return listed.load(f"{self.path(name)}/batch_id={batch_id}").select("path", F.col("length").alias("bytes"))

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The table with its ``batch_id``.

        With a schema, columns a batch lacks are null and an absent table is an empty one; no file
        is opened to find the schema.
        """
        if schema is not None:
            full = f"{schema}, batch_id string"
            if not self.exists(name):
                return self.spark.createDataFrame([], full)
            return self.spark.read.schema(full).parquet(self.path(name))
        if not self.exists(name):
            raise FileNotFoundError(self.path(name))
        return self.spark.read.parquet(self.path(name)).withColumn("batch_id", F.col("batch_id").cast("string"))

    # snapshots ---------------------------------------------------------------------------------

    def snapshots(self, name: str) -> list[str]:
        """Ids of complete snapshots, oldest first."""
        fs, p = self._fs(self.path(name))
        if not fs.exists(p):
            return []
        jvm = self.spark.sparkContext._jvm
        found = []
        for status in fs.listStatus(p):
            leaf = status.getPath().getName()
            if leaf.startswith("snapshot_id=") and fs.exists(
                    jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(leaf.removeprefix("snapshot_id="))
        return sorted(found)

    def write_snapshot(self, name: str, df: DataFrame, snapshot_id: str | None = None) -> str:
        """Write a new state; ids sort by time."""
        new = snapshot_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        df.write.mode("overwrite").option("compression", "snappy").parquet(f"{self.path(name)}/snapshot_id={new}")
        return new

    def read_snapshot(self, name: str, fallback: DataFrame | None = None) -> DataFrame:
        """The newest complete snapshot, else ``fallback``."""
        ids = self.snapshots(name)
        if ids:
            return self.spark.read.parquet(f"{self.path(name)}/snapshot_id={ids[-1]}")
        if fallback is None:
            raise FileNotFoundError(f"no snapshot of {name} under {self.root}")
        return fallback
