"""Finding files to ingest as a stateful stream.

Looks at files (path, size, time) and outcomes of their ingest come in as one stream, from whatever lists a directory or
is told about arrivals. For each path the state holds the last look and the claim on it. A file is ready when two looks
in a row are equal, so one that is still growing waits. Being ready claims the file at that size and time, and nothing
is reported twice while the claim holds: an hour for an ingest that has not come back, 7 days for a failed one, 30 days
for a finished one. Timers end claims and forget paths that nobody looks at any more, so the state does not grow with
the files that ever were; what was extracted is for the version ledger to know, which opens no unchanged file.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.state import COMPLETED, FAILED, IN_PROGRESS

LOOK_SCHEMA = "path string, length bigint, modificationTime timestamp, seen_at timestamp, outcome string"
READY_SCHEMA = "path string, length bigint, modificationTime timestamp, attempt bigint"
# How long a claim holds by status, in seconds.
EXPIRY = {IN_PROGRESS: 3600, FAILED: 7 * 86400, COMPLETED: 30 * 86400}
FORGET = 30 * 86400
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Claims(StatefulProcessor):
    """The looks at one path and the claim on it. Times are milliseconds; sizes and times of a file are compared as they are."""

    def __init__(self, expiry: dict[str, float], forget: float):
        self.expiry = {status: int(1000 * s) for status, s in expiry.items()}
        self.forget = int(1000 * forget)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.look = handle.getValueState("look", "length bigint, modified bigint, until bigint")
        self.claim = handle.getValueState("claim", "length bigint, modified bigint, status string, until bigint, attempt bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for row in sorted(rows, key=lambda r: (r["seen_at"], r["outcome"] is None)):
            at = (row["length"], row["modified"])
            claim = self.claim.get() if self.claim.exists() else None
            mine = claim is not None and (claim[0], claim[1]) == at and claim[3] > now
            if row["outcome"] is not None:
                if mine and row["outcome"] in self.expiry:
                    self._hold(now, *at, row["outcome"], claim[4])
                continue
            last = self.look.get() if self.look.exists() else None
            self.look.update((*at, now + self.forget))
            self.handle.registerTimer(now + self.forget)
            if last is None or (last[0], last[1]) != at or mine:
                continue
            attempt = claim[4] + 1 if claim is not None and (claim[0], claim[1]) == at else 1
            self._hold(now, *at, IN_PROGRESS, attempt)
            yield Row(path=key[0], length=at[0], modified=at[1], attempt=attempt)

    def _hold(self, now: int, length: int, modified: int, status: str, attempt: int) -> None:
        until = now + self.expiry[status]
        self.claim.update((length, modified, status, until, attempt))
        self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        # an ingest that never came back stays as a count of attempts; other claims are over
        if self.claim.exists() and self.claim.get()[3] <= now and self.claim.get()[2] != IN_PROGRESS:
            self.claim.clear()
        if self.look.exists() and self.look.get()[2] <= now:
            self.look.clear()
            self.claim.clear()
        return iter(())

    def close(self) -> None:
        pass


def ready_files(looks: DataFrame, expiry: dict[str, float] | None = None, forget: float = FORGET) -> DataFrame:
    """A stream of files to ingest (path, length, modificationTime, attempt) from a stream of looks and outcomes.

    ``looks`` has the columns of ``LOOK_SCHEMA``; ``outcome`` is null in a look, and COMPLETED or FAILED in the report on
    a file that was ready. The session's state store provider is RocksDB (``PROVIDER``).
    """
    keyed = looks.select("path", "length", F.unix_micros(F.col("modificationTime").cast("timestamp")).alias("modified"), "seen_at", "outcome")
    found = keyed.groupBy("path").transformWithState(
        statefulProcessor=Claims({**EXPIRY, **(expiry or {})}, forget), outputStructType="path string, length bigint, modified bigint, attempt bigint",
        outputMode="Append", timeMode="ProcessingTime")
    return found.select("path", "length", F.timestamp_micros("modified").alias("modificationTime"), "attempt")
