"""Stateful discovery: growing files wait, claims hold and expire, forgotten paths leave the state."""

import datetime as dt
import time

import pytest

from storelens.sources import contracts as ct
from storelens.sources.tables import Warehouse
from storelens.streaming import arrivals
from storelens.streaming import discovery as ds
from tests.test_ingest import config, good_rows, put, sheet

T = dt.datetime(2024, 1, 1)


@pytest.fixture
def stream(spark, tmp_path):
    """Feeds a running stream look by look; each call gives what became ready. A stream with timers never comes to an end
    by itself, so it is stopped."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ds.PROVIDER)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    found, fed, queries = [], [], []

    def feed(*rows, **options):
        n = len(fed)
        looks = [(p, size, T + dt.timedelta(seconds=at), T + dt.timedelta(minutes=n, seconds=i), outcome) for i, (p, size, at, outcome) in enumerate(rows)]
        fed.append(len(rows))
        spark.createDataFrame(looks, ds.LOOK_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "looks"))
        if not queries:
            queries.append(ds.ready_files(spark.readStream.schema(ds.LOOK_SCHEMA).parquet(str(tmp_path / "looks")), **options).writeStream
                           .foreachBatch(lambda df, _: found.extend(sorted((r.path, r.length, r.attempt) for r in df.collect())))
                           .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="1 second").start())
        end, seen = time.time() + 120, 0
        while seen < sum(fed) and time.time() < end and queries[0].exception() is None:
            time.sleep(0.3)
            seen = sum(p["numInputRows"] for p in queries[0].recentProgress)
        assert queries[0].exception() is None and seen == sum(fed)
        out = list(found)
        found.clear()
        return out
    yield feed
    for q in queries:
        q.stop()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_files_are_ready_when_they_stop_growing_and_claims_expire(stream):
    quick = {"expiry": {"IN_PROGRESS": 15, "FAILED": 15, "COMPLETED": 3600}}
    assert stream(("a", 10, 0, None), ("b", 5, 0, None), **quick) == []
    # b has grown, a has not; two looks in one batch count, too
    assert stream(("a", 10, 0, None), ("b", 9, 3, None), ("c", 1, 0, None), ("c", 1, 0, None), **quick) == [("a", 10, 1), ("c", 1, 1)]
    assert stream(("b", 9, 3, None), ("a", 10, 0, "COMPLETED"), ("a", 10, 0, None), ("c", 1, 0, None), **quick) == [("b", 9, 1)]
    time.sleep(17)
    # a is finished for long; the ingests of b and c never came back, c now under way again
    assert stream(("a", 10, 0, None), ("b", 9, 3, None), ("c", 1, 0, None), **quick) == [("b", 9, 2), ("c", 1, 2)]
    # another time alone is another version; an outcome of an old version changes nothing
    assert stream(("a", 10, 7, None), ("a", 10, 0, "FAILED"), ("c", 1, 0, "FAILED"), **quick) == []
    assert stream(("a", 10, 7, None), **quick) == [("a", 10, 1)]
    time.sleep(17)
    assert stream(("c", 1, 0, None), **quick) == [("c", 1, 1)]  # a failure is tried afresh when its claim is over


def test_forgotten_paths_start_anew(stream):
    assert stream(("a", 1, 0, None), forget=8) == []
    time.sleep(12)
    assert stream(("x", 1, 0, None), forget=8) == []  # timers run with the batch
    assert stream(("a", 1, 0, None), forget=8) == []  # a first look again
    assert stream(("a", 1, 0, None), forget=8) == [("a", 1, 1)]


def test_ready_files_are_ingested_and_reported(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    put(inbox / "store_a.xlsx", {"Sales_1": sheet(good_rows(2))})
    put(inbox / "store_bad.xlsx", b"no workbook")
    put(inbox / "other.xlsx", {"Sales_1": sheet(good_rows(1))})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    arrivals.record_looks(spark, str(inbox), wh, "look-1")
    looks = wh.read(arrivals.LOOKS, ds.LOOK_SCHEMA)
    assert looks.where("outcome is null and seen_at is not null").count() == 3
    ready = looks.select("path", "length", "modificationTime").persist()
    ready.count()
    done = arrivals.ingest_ready(ready, ct.parse_contracts(config()), wh, "ready-1")
    assert done.where("success").count() == 1
    ended = {r.path.rsplit("/", 1)[1]: (r.outcome, r.length) for r in wh.read(arrivals.LOOKS, ds.LOOK_SCHEMA).where("outcome is not null").collect()}
    assert {n: o for n, (o, _) in ended.items()} == {"store_a.xlsx": "COMPLETED", "store_bad.xlsx": "FAILED", "other.xlsx": "FAILED"}
    assert all(size == (inbox / n).stat().st_size for n, (_, size) in ended.items())
