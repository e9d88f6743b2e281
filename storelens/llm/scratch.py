"""Stored intermediates of iterative operators.

A checkpointed frame keeps the size its plan was estimated at; over rounds of joins these estimates multiply until
planning alone takes minutes. Tables read back from Parquet have their real size. Rounds that nobody reads any more
are deleted.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.materialize import ensure_checkpoint_dir


class Scratch:
    """A folder under the shared checkpoint folder with numbered tables."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = self.gone = 0
        self.tables: list[str] = []

    def keep(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` stored by hash of ``column``: joins on it leave these rows where they are."""
        name = f"kept_{uuid.uuid4().hex}"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(parts, column).format("parquet").option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Delete everything; frames that read it end here."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def forget(self, before: int) -> None:
        """Delete the tables with numbers below ``before``."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for n in range(self.gone, before):
            path = hadoop.Path(f"{self.folder}/{n}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.gone = max(self.gone, before)


def kept(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once, stored and read back."""
    return Scratch(df.sparkSession, name).keep(df)


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage now: Spark then deletes the shuffle files that no plan refers to any more,
    which otherwise stay on the executors' disks until the driver happens to collect."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
