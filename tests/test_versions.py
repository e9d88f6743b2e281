"""The version ledger and the incremental figures: edits, changes back, equal contents, unopened files."""

import datetime as dt
import json
import os

import pytest

from storelens.catalog.workbooks import workbook_bytes
from storelens.operators import aggregate, kpi, loads, state
from storelens.plans import full_run, ingest
from storelens.plans.transform import current_versions, load_kpi_data, staged_sales
from storelens.sources import contracts as ct
from storelens.sources.tables import Warehouse
from tests.test_ingest import NOW, config, good_rows, put, sheet

D = dt.date


@pytest.fixture
def inbox(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    return d


def ledger(wh):
    rows = wh.read(ingest.VERSIONS, state.VERSION_SCHEMA).collect()
    return sorted((os.path.basename(r.path), r.version) for r in rows)


def served(wh):
    return sorted((os.path.basename(r.source_file), r.date.day, r.qty) for r in staged_sales(wh).collect())


def test_unchanged_files_are_not_opened(spark, inbox, tmp_path):
    contracts = ct.parse_contracts(config())
    wh = Warehouse(spark, str(tmp_path / "wh"))
    name = inbox / "store_a [1] {x}+%20.xlsx"  # characters that mean something in globs and URLs
    put(name, {"Sales_1": sheet(good_rows(2))})
    assert ingest.run_ingest(spark, str(inbox), contracts, wh, options=NOW).where("success").count() == 1
    entries = sorted(os.walk(wh.root))
    # other bytes of the same size under the same time: a run that opened the file would see another content
    was = name.stat()
    name.write_bytes(b"x" * was.st_size)
    os.utime(name, ns=(was.st_atime_ns, was.st_mtime_ns))
    assert ingest.run_ingest(spark, str(inbox), contracts, wh, options=NOW).count() == 0
    assert sorted(os.walk(wh.root)) == entries
    # a new time alone: opened, found to be something else, and tried
    os.utime(name, ns=(was.st_atime_ns, was.st_mtime_ns - 5_000_000_000))
    assert ingest.run_ingest(spark, str(inbox), contracts, wh, options=NOW).where("not success").count() == 1
    assert [v for _, v in ledger(wh)] == [1, 2]
    assert len(served(wh)) == 2  # the newest version that could be read


def test_a_touched_file_keeps_its_version(spark, inbox, tmp_path):
    contracts = ct.parse_contracts(config())
    wh = Warehouse(spark, str(tmp_path / "wh"))
    put(inbox / "store_a.xlsx", {"Sales_1": sheet(good_rows(2))})
    ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b1", options=NOW)
    os.utime(inbox / "store_a.xlsx", (1_700_000_000, 1_700_000_000))
    assert ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b2", options=NOW).count() == 0
    assert ledger(wh) == [("store_a.xlsx", 1), ("store_a.xlsx", 1)]
    entries = sorted(os.walk(wh.root))
    assert ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b3", options=NOW).count() == 0
    assert sorted(os.walk(wh.root)) == entries


def test_changes_back_and_equal_contents(spark, inbox, tmp_path):
    contracts = ct.parse_contracts(config())
    wh = Warehouse(spark, str(tmp_path / "wh"))
    a, b = (workbook_bytes({"Sales_1": sheet(rows)}) for rows in (good_rows(2), good_rows(1, 9)))

    def look(batch, **files):
        for n, content in files.items():
            put(inbox / f"store_{n}.xlsx", content)
        return ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id=batch, options=NOW).count()
    assert look("b1", x=a) == 1 and served(wh) == [("store_x.xlsx", 1, 1), ("store_x.xlsx", 2, 2)]
    assert look("b2", x=b) == 1 and served(wh) == [("store_x.xlsx", 9, 1)]
    assert look("b3", x=a) == 0 and served(wh) == [("store_x.xlsx", 1, 1), ("store_x.xlsx", 2, 2)]
    # another file takes the content: it counts once, and on when the first one changes
    assert look("b4", y=a) == 0 and len(served(wh)) == 2
    assert look("b5", x=b) == 0 and served(wh) == [("store_x.xlsx", 1, 1), ("store_x.xlsx", 2, 2), ("store_x.xlsx", 9, 1)]
    assert look("b6", y=b) == 0 and served(wh) == [("store_x.xlsx", 9, 1)]
    # a version that cannot be read leaves the last good one
    assert look("b7", y=b"broken") == 1 and served(wh) == [("store_x.xlsx", 9, 1)]
    assert ledger(wh) == [("store_x.xlsx", 1), ("store_x.xlsx", 2), ("store_x.xlsx", 3), ("store_x.xlsx", 4),
                          ("store_y.xlsx", 1), ("store_y.xlsx", 2), ("store_y.xlsx", 3)]


def figures(spark, wh):
    summary = sorted((r.economic_region, r.total_revenue_usd, r.total_transactions, r.total_stores, r.period_end,
                      tuple(sorted(r.currency_exposure.items()))) for r in wh.read_snapshot("regional_summary").collect())
    records = sorted((r.store_id, r.revenue_ytd_usd, r.transaction_count_mtd, r.avg_items_per_transaction, r.performance_tier)
                     for r in wh.read_snapshot("kpi_records").collect())
    table = sorted((r.store_id, r.revenue_mtd, r.transaction_count_mtd, r.avg_basket_size) for r in load_kpi_data(wh).collect())
    return summary, records, table


def test_figures_follow_versions_without_reading_sales(spark, inbox, tmp_path):
    path = tmp_path / "contracts.json"
    path.write_text(json.dumps(config()))
    wh, n = Warehouse(spark, str(tmp_path / "wh")), iter(range(100))

    def go(root=wh):
        return full_run.run(spark, str(path), str(inbox), root.root, reference_date=D(2024, 1, 31), run_id=f"r{next(n)}", options=NOW)

    def afresh():
        root = Warehouse(spark, str(tmp_path / f"once{next(n)}"))
        go(root)
        return figures(spark, root)
    first, edited = (workbook_bytes({"Sales_1": sheet(rows)}) for rows in (good_rows(2), good_rows(3, 20)))
    put(inbox / "store_CN_001_sales_2024.xlsx", first)
    put(inbox / "store_JP_001_sales_1.xlsx", {"Sales_1": sheet(good_rows(1, 5)), "Inventory_Levels": [["SKU", "Current Stock"], ["S", 1]]})
    assert go()["rows"] == 3
    start = figures(spark, wh)
    put(inbox / "store_CN_001_sales_2024.xlsx", edited)
    assert go()["rows"] == 3 and figures(spark, wh) != start
    sales_files = sorted(p for p, _, _ in os.walk(wh.path("sales_transactions")))
    put(inbox / "store_CN_001_sales_2024.xlsx", first)
    assert go() == {"files": 0, "rows": 0} and figures(spark, wh) == start == afresh()
    assert sorted(p for p, _, _ in os.walk(wh.path("sales_transactions"))) == sales_files
    snapshots = wh.snapshots("kpi_records")
    assert go() == {"files": 0, "rows": 0} and wh.snapshots("kpi_records") == snapshots  # nothing changed: nothing computed
    # the figures' plan reads the sums by day and no sales
    sums = kpi.store_sums(loads.loaded_day_sums(wh, current_versions(wh)), D(2024, 1, 31), days=True)
    read = sums.inputFiles()
    assert [f for f in read if f"/{loads.DAY_SUMS}/" in f] and not [f for f in read if "sales_transactions" in f or "staging/" in f]


def test_sums_by_day_give_the_same_figures(spark):
    rows = [(f"s{i % 7}", None if i % 50 == 0 else D(1999 + i % 2, 1 + i % 12, 1 + i % 28), None if i % 9 == 0 else i % 13,
             None if i % 11 == 0 else (i * 0.1 - 20) / 3, ["USD", "JPY", None][i % 3], ["R1", "R2", None][i % 7 % 3], "urban", i % 5)
            for i in range(2000)]
    sales = spark.createDataFrame(rows, "store_id string, date date, qty long, revenue_usd double, original_currency string, "
                                        "economic_region string, urban_rural string, stores_within_10km long")
    stores = sales.groupBy("store_id", "economic_region", "urban_rural").agg({"stores_within_10km": "max"}).withColumnRenamed(
        "max(stores_within_10km)", "stores_within_10km")
    bare = sales.select("store_id", "date", "qty", "revenue_usd", "original_currency")
    days = loads.day_sums(bare)
    for make in (lambda f, d: kpi.store_kpi_table(stores, f, D(2000, 6, 30), days=d), lambda f, d: kpi.store_sums(f, D(2000, 6, 30), days=d),
                 lambda f, d: kpi.calculate_store_kpis(f, D(2000, 6, 30), stores=stores, days=d),
                 lambda f, d: aggregate.full_regional_summary(f.join(stores, "store_id"), days=d)):
        whole, summed = (sorted((str(r) for r in make(f, d).collect())) for f, d in ((bare, False), (days, True)))
        assert whole == summed
