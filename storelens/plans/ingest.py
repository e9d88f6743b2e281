"""Ingest: one job over all new files of a batch.

    stable -> changed since the last look -> content hash -> not yet completed -> contract -> sheets -> decode
           -> typed and checked -> staging | dead letters | state events | results | manifest | versions

Files whose size and time are those of the last look are not opened. Each stage is a DataFrame over all files. The decoded cells are stored once; everything written
after that comes from the stored cells. Every write is keyed by the batch, so running a batch again
after a lost driver replaces its own output and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import join_dimension
from ..functions.materialize import intermediates_deleted, stored
from ..operators import state
from ..sources import contracts as ct
from ..sources import files as fs
from ..sources import text_sheets, workbook
from ..sources.contracts import StoreContract
from ..sources.tables import Warehouse

STAGING, DEAD_LETTERS, RESOLUTIONS = "staging", "dead_letter", "dead_letter_resolution"
STATE, RESULTS, MANIFEST = "extraction_state", "extraction_results", "staging_manifest"
VERSIONS, STAGED_FILES = "file_versions", "staged_files"
RESULT_SCHEMA = ("file_hash string, source_file string, store_id string, success boolean, "
                 "sheets_extracted array<string>, errors array<struct<sheet_type:string,error:string>>, rows bigint")


@dataclass(frozen=True)
class IngestOptions:
    reject: str = "sheet"
    signed_integers: bool = False
    stable_seconds: int = fs.STABLE_SECONDS
    keep_content: bool = True


def new_files(looks: DataFrame, completed: DataFrame) -> DataFrame:
    """(path, length, modificationTime, file_hash) of opened files whose content is not completed yet."""
    return looks.join(completed.select("file_hash"), "file_hash", "left_anti")


def first_of_equal(matched: DataFrame) -> DataFrame:
    """Files of one content count once, the smallest path. Files without a contract all stay."""
    rest = [c for c in matched.columns if c != "file_hash"]
    known = matched.where(F.col("store_id").isNotNull()).groupBy("file_hash").agg(
        F.min(F.struct("path", *[c for c in rest if c != "path"])).alias("_f"))
    return known.select("file_hash", "_f.*").unionByName(matched.where(F.col("store_id").isNull()))


def _failures(rows: DataFrame, error_type: str, contents: DataFrame | None, batch_id: str) -> DataFrame:
    """Dead-letter rows from (path, store_id, error, sheet_type, length, modificationTime, file_hash).

    A failure belongs to its batch: a file that fails again is a new failure, pending again.
    """
    failure = F.sha2(F.concat_ws("|", F.lit(batch_id), "file_hash", "path", F.coalesce("sheet_type", F.lit("")), F.lit(error_type)), 256)
    out = rows.select(
        failure.alias("failure_id"), F.col("path").alias("file_path"), "store_id",
        F.lit(error_type).alias("error_type"), F.col("error").alias("error_message"),
        F.map_filter(F.create_map(F.lit("sheet_type"), F.col("sheet_type"), F.lit("file_hash"), F.col("file_hash")),
                     lambda k, v: v.isNotNull()).alias("context"),
        F.col("length").alias("file_size"), F.col("modificationTime").alias("file_modified"))
    if contents is not None:
        # only the failed files' bytes move: their paths are few, everything else is left where it is read
        failed = stored(out, "failures")
        content = join_dimension(contents.select(F.col("path").alias("file_path"), "content"),
                                 failed.select("file_path").distinct(), ["file_path"], "inner")
        out = failed.join(content, "file_path", "left")
    else:
        out = out.withColumn("content", F.lit(None).cast("binary"))
    return out.withColumn("failed_at", F.current_timestamp()).select(
        "failure_id", "file_path", "store_id", "error_type", "error_message", "context", "file_size",
        "file_modified", "content", "failed_at")


def _events(rows: DataFrame, status: str, **values) -> DataFrame:
    columns = {"store_id": F.lit(None).cast("string"), "extraction_id": F.lit(None).cast("string"),
               "sheets_extracted": F.lit(None).cast("bigint"), "errors": F.lit(None).cast("bigint"),
               "error": F.lit(None).cast("string"), **values}
    return rows.select("file_hash", F.col("source_file").alias("file_path"),
                       columns["store_id"].alias("store_id"), F.lit(status).alias("status"),
                       *[columns[c].alias(c) for c in ("extraction_id", "sheets_extracted", "errors", "error")],
                       F.current_timestamp().alias("event_ts"))


def ingest_files(
    files: DataFrame, contracts: Sequence[StoreContract] | DataFrame, wh: Warehouse, batch_id: str | None = None,
    options: IngestOptions = IngestOptions(), reopen: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Ingest a batch of files (path, modificationTime, length, content); returns the per-file results.

    ``reopen`` gives the content of chosen files (path) where reading ``files`` would open all of them.
    """
    batch_id = batch_id or uuid.uuid4().hex
    with intermediates_deleted(wh.spark):
        _ingest(files, contracts, wh, batch_id, options, reopen)
    return wh.read(RESULTS, RESULT_SCHEMA).where(F.col("batch_id") == batch_id).drop("batch_id")


def _ingest(files: DataFrame, contracts: Sequence[StoreContract] | DataFrame, wh: Warehouse, batch_id: str,
            options: IngestOptions, reopen: Callable[[DataFrame], DataFrame] | None) -> None:
    spark = wh.spark
    book = contracts if isinstance(contracts, DataFrame) else ct.contracts_frame(spark, contracts)
    # a repeated batch must not see its own earlier events as "already done"
    history = wh.read(STATE, state.STATE_SCHEMA).where(F.col("batch_id") != batch_id)
    ledger = wh.read(VERSIONS, state.VERSION_SCHEMA).where(F.col("batch_id") != batch_id)
    completed = state.completed_hashes(history)
    files = fs.stable(fs.only_workbooks(files), seconds=options.stable_seconds)
    changed = stored(state.changed_files(files, ledger, completed), "changed-files")
    if changed.isEmpty():  # nothing is opened or written for a look that finds nothing
        return
    opened = join_dimension(files, changed.select("path"), ["path"], "inner") if reopen is None else reopen(changed)
    looks = stored(opened.select("path", "length", "modificationTime", F.sha2("content", 256).alias("file_hash")), "looks")
    versions = state.next_versions(looks, ledger)
    fresh = stored(new_files(looks, completed), "new-files")
    matched = fs.match_contracts(fresh, book)
    fresh = stored(first_of_equal(fresh.join(matched, "path")), "matched-files")
    if fresh.isEmpty():  # touched files, or contents that are extracted already
        wh.append(VERSIONS, versions, batch_id)
        return
    known = fresh.where(F.col("store_id").isNotNull())
    contents = join_dimension(opened, known.select("path", "file_hash"), ["path"], "inner")

    books = contents.where(~fs.is_text())
    sheets = stored(workbook.sheet_names(books).unionByName(text_sheets.sheet_names(known.where(fs.is_text()))), "sheet-names")
    picks = fs.pick_sheets(sheets.where("sheet is not null"), known.select("path", "store_id"), book)
    picks = stored(picks.join(sheets.where("error is not null").select("path", F.col("error").alias("_broken")),
                              "path", "left").withColumn("error", F.coalesce("_broken", "error")).drop("_broken"), "picks")
    cells = stored(workbook.decode(books, picks.where(~fs.is_text())).unionByName(text_sheets.decode(spark, picks)), "cells")

    # rows read before a sheet broke off are no rows of that sheet
    broken = cells.where("error is not null").select("path", "sheet_type").distinct()
    typed = ct.apply_contracts(
        cells.where("error is null").join(broken, ["path", "sheet_type"], "left_anti").select("store_id", "sheet_type", F.col("path").alias("source_file"),
                                            "row_no", "cells"), book, signed_integers=options.signed_integers)
    typed = stored(typed, "typed")
    rejected = stored(ct.rejected_sheets(typed), "rejected")
    blocking = rejected
    if options.reject == "row":
        no_header = typed.where((F.col("row_no") == 0) & (F.size("violations") > 0)).select(*ct.SHEET_KEYS)
        blocking = rejected.join(no_header, list(ct.SHEET_KEYS), "left_semi")
    rows = ct.stamp_lineage(ct.accepted_rows(typed, options.reject), book)
    rows = rows.withColumn("extraction_date", F.to_date("extraction_timestamp"))
    wh.append(STAGING, rows, batch_id, ("store_id", "extraction_date", "sheet_type"))

    # one record per sheet a contract asks for: its rows or its error
    errors = (picks.where("error is not null").select("path", "sheet_type", "error")
              .unionByName(cells.where("error is not null").select("path", "sheet_type", "error"))
              .unionByName(blocking.select(F.col("source_file").alias("path"), "sheet_type",
                                           F.col("error_message").alias("error"))))
    counts = ct.accepted_rows(typed, options.reject).groupBy(F.col("source_file").alias("path"), "sheet_type").agg(
        F.count(F.lit(1)).alias("rows"))
    per_sheet = stored(
        picks.select("path", "store_id", "sheet_type").join(errors, ["path", "sheet_type"], "left")
        .join(counts, ["path", "sheet_type"], "left").join(fresh.drop("store_id"), "path"), "per-sheet")
    results = state.extraction_results(per_sheet.select(
        "file_hash", F.col("path").alias("source_file"), "store_id", "sheet_type",
        F.coalesce("rows", F.lit(0)).alias("rows"), "error"))
    wh.append(RESULTS, results, batch_id)
    wh.append(MANIFEST, state.staging_manifest(rows), batch_id)
    wh.append(STAGED_FILES, state.staged_files(wh.files(STAGING, batch_id)), batch_id)

    kept = opened if options.keep_content else None
    unmatched = fresh.where(F.col("store_id").isNull()).withColumns({
        "error": F.concat(F.lit("no contract matches "), "path"), "sheet_type": F.lit(None).cast("string")})
    letters = _failures(unmatched, "NoMatchingContract", kept, batch_id).unionByName(
        _failures(per_sheet.where("error is not null"), "SheetRejected", kept, batch_id))
    wh.append(DEAD_LETTERS, letters, batch_id)

    done = wh.read(RESULTS, RESULT_SCHEMA).where(F.col("batch_id") == batch_id)
    any_sheet = F.size("sheets_extracted") > 0
    events = (
        _events(done, state.IN_PROGRESS, store_id=F.col("store_id"))
        .unionByName(_events(done.where(any_sheet), state.COMPLETED, extraction_id=F.lit(batch_id),
                             sheets_extracted=F.size("sheets_extracted").cast("bigint"),
                             errors=F.size("errors").cast("bigint")))
        .unionByName(_events(done.where(~any_sheet), state.FAILED, error=F.to_json("errors"))))
    wh.append(VERSIONS, versions, batch_id)
    # last write: a file counts as done only when all its output is there
    wh.append(STATE, events, batch_id)


def run_ingest(
    spark: SparkSession, directory: str | Sequence[str], contracts: Sequence[StoreContract], wh: Warehouse, *,
    mode: str = "batch", pattern: str = "*.xlsx", batch_id: str | None = None,
    options: IngestOptions = IngestOptions(),
):
    """``batch``: everything under ``directory``. ``reprocess-dlq``: pending failures that still exist.
    ``watch``: a streaming query that looks again at every tick."""
    if mode == "watch":
        from ..streaming.arrivals import watch
        return watch(spark, directory, contracts, wh, pattern=pattern, options=options)
    files = fs.scan(spark, directory, pattern)
    if mode == "batch":
        return ingest_files(files, contracts, wh, batch_id, options, lambda chosen: fs.reopen(spark, chosen))
    if mode == "reprocess-dlq":
        return reprocess_dead_letters(spark, files, contracts, wh, batch_id, options)
    raise ValueError("mode must be batch, watch or reprocess-dlq")


def reprocess_dead_letters(
    spark: SparkSession, files: DataFrame, contracts: Sequence[StoreContract], wh: Warehouse,
    batch_id: str | None = None, options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Ingest the files of pending failures again and record how each failure ended."""
    batch_id = batch_id or uuid.uuid4().hex
    failures = wh.read(DEAD_LETTERS, state.DEAD_LETTER_SCHEMA).drop("batch_id", "content")
    resolved = wh.read(RESOLUTIONS, state.RESOLUTION_SCHEMA).drop("batch_id")
    open_failures = failures.join(resolved.select("failure_id"), "failure_id", "left_anti")
    with intermediates_deleted(spark):
        return _reprocess(open_failures, files, contracts, wh, batch_id, options)


def _reprocess(open_failures: DataFrame, files: DataFrame, contracts: Sequence[StoreContract], wh: Warehouse, batch_id: str,
               options: IngestOptions) -> DataFrame:
    again = stored(state.reprocessable(open_failures, files.select("path")), "reprocess")
    chosen = files.join(again.select(F.col("file_path").alias("path")).distinct(), "path", "left_semi")
    results = ingest_files(chosen, contracts, wh, batch_id, options)
    good = results.where("success").select(F.col("source_file").alias("file_path")).withColumn("_ok", F.lit(True))
    ended = again.select("failure_id", "file_path").distinct().join(good, "file_path", "left")
    wh.append(RESOLUTIONS, state.resolutions(
        ended, F.when(F.col("_ok"), "SUCCESS").otherwise("FAILED"), F.current_timestamp()), batch_id)
    return results
