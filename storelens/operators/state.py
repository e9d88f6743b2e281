"""Dead letters and extraction state as append-only event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEAD_LETTER_SCHEMA = (
    "failure_id string, file_path string, store_id string, error_type string, error_message string, "
    "context map<string,string>, file_size bigint, file_modified timestamp, content binary, failed_at timestamp")
RESOLUTION_SCHEMA = "failure_id string, outcome string, resolved_at timestamp"
STATE_SCHEMA = (
    "file_hash string, file_path string, store_id string, status string, extraction_id string, "
    "sheets_extracted bigint, errors bigint, error string, event_ts timestamp")
# every look at a file's content: size and time of the file decide whether it is opened again
VERSION_SCHEMA = "path string, version bigint, size bigint, modified timestamp, file_hash string, seen_at timestamp"

IN_PROGRESS, COMPLETED, FAILED = "IN_PROGRESS", "COMPLETED", "FAILED"


def _latest(df: DataFrame, key: str, at: str, *tie: str) -> DataFrame:
    """The newest row per key, chosen before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, *tie)).alias("_r"))
            .select(key, "_r.*"))


# dead letters ---------------------------------------------------------------------------------

def resolutions(failures: DataFrame, outcome: Column, at: Column) -> DataFrame:
    """Resolution events (SUCCESS or FAILED) for failures."""
    return failures.select("failure_id", outcome.alias("outcome"), at.alias("resolved_at"))


def failure_status(failures: DataFrame, resolved: DataFrame) -> DataFrame:
    """Failures with their newest outcome, PENDING when there is none."""
    last = _latest(resolved.select("failure_id", "outcome", "resolved_at"), "failure_id", "resolved_at", "outcome")
    return failures.join(last, "failure_id", "left").withColumn("outcome", F.coalesce("outcome", F.lit("PENDING")))


def pending_failures(failures: DataFrame, resolved: DataFrame, limit: int = 100) -> DataFrame:
    """The oldest failures nobody has reprocessed."""
    return (failures.join(resolved.select("failure_id"), "failure_id", "left_anti")
            .orderBy("failed_at", "failure_id").limit(limit))


def dead_letter_statistics(failures: DataFrame, resolved: DataFrame) -> DataFrame:
    """(dimension, value, entries): total, by error type, by store, pending and resolved.

    One grouping-sets aggregate; the outcome comes from a join on the failure.
    """
    status = failure_status(failures, resolved).select(
        F.coalesce("error_type", F.lit("Unknown")).alias("error_type"),
        F.coalesce("store_id", F.lit("Unknown")).alias("store_id"),
        F.when(F.col("outcome") == "PENDING", "pending").otherwise("resolved").alias("state"))
    sets = [[F.col("error_type")], [F.col("store_id")], [F.col("state")], []]
    grouped = status.groupingSets(sets, "error_type", "store_id", "state").agg(
        F.count(F.lit(1)).alias("entries"), F.grouping_id().alias("_g"))
    dimension = F.when(F.col("_g") == 3, "error_type").when(F.col("_g") == 5, "store").when(
        F.col("_g") == 6, "state").otherwise("total")
    return grouped.select(dimension.alias("dimension"),
                          F.coalesce("error_type", "store_id", "state", F.lit("all")).alias("value"), "entries")


def reprocessable(pending: DataFrame, files: DataFrame) -> DataFrame:
    """Pending failures whose file still exists."""
    return pending.join(files.select(F.col("path").alias("file_path")), "file_path", "left_semi")


# extraction state -----------------------------------------------------------------------------

def completed_hashes(events: DataFrame) -> DataFrame:
    return events.where(F.col("status") == COMPLETED).select("file_hash").distinct()


def newest_versions(ledger: DataFrame) -> DataFrame:
    """The last look at each file."""
    return _latest(ledger.select("path", "version", "size", "modified", "file_hash", "seen_at"), "path", "seen_at", "version")


def changed_files(listing: DataFrame, ledger: DataFrame, completed: DataFrame) -> DataFrame:
    """(path, length, modificationTime) of listed files that have to be opened: never seen, of another size or time than at
    the last look, or with a content that no finished extraction holds."""
    settled = newest_versions(ledger).join(completed.select("file_hash"), "file_hash", "left_semi").select(
        "path", F.col("size").alias("length"), F.col("modified").alias("modificationTime"))
    return listing.select("path", "length", "modificationTime").join(
        settled, ["path", "length", "modificationTime"], "left_anti")


def next_versions(looks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows for opened files (path, length, modificationTime, file_hash): another content is the next version of
    its path, also one that the path or another file held before."""
    last = newest_versions(ledger).select("path", F.col("version").alias("_version"), F.col("file_hash").alias("_hash"))
    version = F.coalesce("_version", F.lit(0)) + F.when(F.col("file_hash").eqNullSafe(F.col("_hash")), 0).otherwise(1)
    return looks.join(last, "path", "left").select(
        "path", version.cast("bigint").alias("version"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"), "file_hash", F.current_timestamp().alias("seen_at"))


def current_contents(ledger: DataFrame, events: DataFrame) -> DataFrame:
    """(source_file, batch_id): the extraction of every content that some file's newest finished version holds.

    A content counts once, however many files hold it, and as long as one of them does. ``events`` has batch ids; what
    they finished counts as a look, too.
    """
    done = events.where(F.col("status") == COMPLETED)
    extracted = done.groupBy("file_hash").agg(F.max_by(
        F.struct(F.col("file_path").alias("source_file"), "batch_id"), F.struct("event_ts", "batch_id")).alias("_e"))
    looks = ledger.select("path", "file_hash", "seen_at", F.col("version").alias("_n")).unionByName(done.select(
        F.col("file_path").alias("path"), "file_hash", F.col("event_ts").alias("seen_at"), F.lit(0).cast("bigint").alias("_n")))
    finished = looks.join(extracted.select("file_hash"), "file_hash", "left_semi")
    held = _latest(finished, "path", "seen_at", "_n").select("file_hash").distinct()
    return extracted.join(held, "file_hash", "left_semi").select("_e.source_file", "_e.batch_id")


def current_state(events: DataFrame) -> DataFrame:
    """Newest status per file, with the store its IN_PROGRESS event named."""
    rank = F.when(F.col("status") == IN_PROGRESS, 0).otherwise(1)
    newest = events.groupBy("file_hash").agg(
        F.max_by("status", F.struct("event_ts", rank)).alias("status"),
        F.max_by("store_id", F.when(F.col("store_id").isNotNull(), F.col("event_ts"))).alias("store_id"),
        F.max("event_ts").alias("event_ts"))
    return newest.withColumn("store_id", F.coalesce("store_id", F.lit("unknown")))


def _counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(n) for s, n in (
        (COMPLETED, "total_processed"), (IN_PROGRESS, "in_progress"), (FAILED, "failed"))]


def event_statistics(events: DataFrame) -> DataFrame:
    """Counts of events, as a log reader sees them."""
    return events.agg(*_counts())


def state_statistics(events: DataFrame) -> DataFrame:
    """Counts of files by their newest status, per store."""
    return current_state(events).groupBy("store_id").agg(*_counts())


def extraction_results(sheets: DataFrame) -> DataFrame:
    """One record per file from its sheets (file_hash, source_file, store_id, sheet_type, rows, error)."""
    good = F.col("error").isNull()
    return sheets.groupBy("file_hash", "source_file", "store_id").agg(
        (F.count_if(~good) == 0).alias("success"),
        F.array_sort(F.collect_set(F.when(good, F.col("sheet_type")))).alias("sheets_extracted"),
        F.array_sort(F.collect_list(F.when(~good, F.struct("sheet_type", "error")))).alias("errors"),
        F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("rows"))


def batch_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("files"), F.count_if("success").alias("succeeded"),
                       F.count_if(~F.col("success")).alias("failed"), F.sum("rows").alias("rows"))


def staging_manifest(rows: DataFrame) -> DataFrame:
    """Rows, columns and their names per staged file and sheet."""
    names = [c for c in rows.columns if c != "batch_id"]
    return rows.groupBy("source_file", "store_id", "sheet_type").agg(
        F.count(F.lit(1)).alias("row_count")).withColumns({
            "column_count": F.lit(len(names)), "columns": F.array(*[F.lit(c) for c in names])})


def staged_files(files: DataFrame) -> DataFrame:
    """(store_id, extraction_date, sheet_type, path, bytes) of staged files (path, bytes), from the directories they are in."""
    def part(name: str) -> Column:
        return F.url_decode(F.replace(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    return files.select(part("store_id").alias("store_id"), part("extraction_date").cast("date").alias("extraction_date"),
                        part("sheet_type").alias("sheet_type"), "path", "bytes")
