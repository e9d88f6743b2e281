"""Cutting lineage through storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_SCOPE: ContextVar[list[str] | None] = ContextVar("stored tables of the running job", default=None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only where none is named (local tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="storelens-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored, so later steps see one fixed result and a short lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`checkpointed`, as a parquet table: wide frames keep column pruning and pushdown."""
    return stored_parts([df], name)


def stored_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Frames of one schema (at least one), computed and stored one after the other, as one table."""
    path, scope = None, _SCOPE.get()
    for df in parts:
        if path is None:
            path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
            if scope is not None:
                scope.append(path)
        df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates_deleted(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`stored` wrote inside; nothing that leaves the block may read it."""
    mine: list[str] = []
    token = _SCOPE.set(mine)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in mine:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
