"""Continuous ingest.

A file stream reports each path once, so a workbook that is saved again under its name would be
missed. The default source is therefore a clock: every tick lists the directory for files changed
since the last complete tick, and the content hash decides what is new. Files still being written
are left to a later tick. Where files are never rewritten, ``source="file-stream"`` uses the file
stream itself. :func:`watch_looks` keeps a state per file instead (see ``discovery``): listings are
written as looks, and what two looks in a row found unchanged is ingested.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.state import COMPLETED, DEAD_LETTER_SCHEMA, FAILED
from ..plans.ingest import DEAD_LETTERS, IngestOptions, ingest_files
from ..sources import files as fs
from ..sources.contracts import StoreContract
from ..sources.tables import Warehouse
from .discovery import LOOK_SCHEMA, ready_files

TICKS = "ingest_ticks"
TICK_SCHEMA = "tick string, started_at timestamp"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def last_tick(wh: Warehouse, before: str | None = None) -> dt.datetime | None:
    """Start of the newest complete tick."""
    ticks = wh.read(TICKS, TICK_SCHEMA)
    if before is not None:
        ticks = ticks.where(F.col("batch_id") != before)
    return ticks.agg(F.max("started_at")).first()[0]


def tick(
    spark: SparkSession, directory: str | Sequence[str], contracts: Sequence[StoreContract], wh: Warehouse, tick_id: str, *,
    pattern: str = "*.xlsx", options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """One look at the directory or directories. Repeating a tick repeats its batch, not its effects."""
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    since = last_tick(wh, before=tick_id)
    after = None
    if since is not None:
        # files that were too young at the last tick are older than it: look back past the wait
        back = since - dt.timedelta(seconds=2 * options.stable_seconds + 1)
        after = back.strftime("%Y-%m-%dT%H:%M:%S")
    found = fs.scan(spark, directory, pattern, modified_after=after)
    results = ingest_files(found, contracts, wh, tick_id, options, lambda chosen: fs.reopen(spark, chosen))
    if results.isEmpty():  # the next tick looks at the same span again, and nothing is written
        return results
    mark = spark.createDataFrame([(tick_id, started)], TICK_SCHEMA)
    wh.append(TICKS, mark, tick_id)
    return results


def watch(
    spark: SparkSession, directory: str | Sequence[str], contracts: Sequence[StoreContract], wh: Warehouse, *,
    pattern: str = "*.xlsx", every: str = "30 seconds", source: str = "clock",
    options: IngestOptions = IngestOptions(), available_now: bool = False,
):
    """Start the streaming query; its checkpoint lives in the warehouse."""
    if source == "clock":
        stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

        def handle(_: DataFrame, batch: int) -> None:
            tick(spark, directory, contracts, wh, f"tick-{batch:012d}", pattern=pattern, options=options)
    elif source == "file-stream":
        stream = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", pattern)
                  .option("recursiveFileLookup", "true").load(directory if isinstance(directory, str) else ",".join(directory)))

        def handle(files: DataFrame, batch: int) -> None:
            ingest_files(files, contracts, wh, f"stream-{batch:012d}", options)
    else:
        raise ValueError("source must be clock or file-stream")
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", wh.path(f"_watch_{source}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


LOOKS = "file_looks"


def record_looks(spark: SparkSession, directory: str | Sequence[str], wh: Warehouse, look_id: str, pattern: str = "*.xlsx") -> None:
    """Write one listing as looks; no file is opened."""
    listed = fs.scan(spark, directory, pattern).select(
        "path", "length", "modificationTime", F.current_timestamp().alias("seen_at"), F.lit(None).cast("string").alias("outcome"))
    wh.append(LOOKS, listed, look_id)


def ingest_ready(
    ready: DataFrame, contracts: Sequence[StoreContract], wh: Warehouse, batch_id: str, options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Ingest the files that became ready (path, length, modificationTime) and report how it ended, as looks with an outcome.

    A file whose content was extracted before has no result of its own and counts as completed.
    """
    spark = wh.spark
    results = ingest_files(fs.reopen(spark, ready), contracts, wh, batch_id, replace(options, stable_seconds=0),
                           lambda chosen: fs.reopen(spark, chosen))
    failed = results.where(F.size("sheets_extracted") == 0).select(F.col("source_file").alias("path"), F.lit(FAILED).alias("_failed"))
    letters = wh.read(DEAD_LETTERS, DEAD_LETTER_SCHEMA).where(F.col("batch_id") == batch_id).where("error_type = 'NoMatchingContract'")
    failed = failed.unionByName(letters.select(F.col("file_path").alias("path"), F.lit(FAILED).alias("_failed"))).distinct()
    ended = ready.select("path", "length", "modificationTime").join(failed, "path", "left").select(
        "path", "length", "modificationTime", F.current_timestamp().alias("seen_at"), F.coalesce("_failed", F.lit(COMPLETED)).alias("outcome"))
    wh.append(LOOKS, ended, f"outcome-{batch_id}")
    return results


def watch_looks(
    spark: SparkSession, directory: str | Sequence[str], contracts: Sequence[StoreContract], wh: Warehouse, *,
    pattern: str = "*.xlsx", every: str = "30 seconds", options: IngestOptions = IngestOptions(),
):
    """Start two streaming queries: one lists the directory every so often, the other ingests what became ready."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    lister = clock.writeStream.foreachBatch(lambda _, n: record_looks(spark, directory, wh, f"look-{n:012d}", pattern)).option(
        "checkpointLocation", wh.path("_watch_lister")).trigger(processingTime=every).start()

    def handle(ready: DataFrame, n: int) -> None:
        ready = ready.persist()
        if not ready.isEmpty():
            ingest_ready(ready, contracts, wh, f"ready-{n:012d}", options)
        ready.unpersist()
    record_looks(spark, directory, wh, "look-start", pattern)  # a stream needs its folder
    looks = spark.readStream.schema(f"{LOOK_SCHEMA}, batch_id string").parquet(wh.path(LOOKS)).drop("batch_id")
    ingester = ready_files(looks).writeStream.foreachBatch(handle).option(
        "checkpointLocation", wh.path("_watch_ready")).trigger(processingTime=every).start()
    return lister, ingester
