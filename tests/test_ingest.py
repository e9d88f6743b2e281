"""Contracts, workbooks, ingest, streaming, tables and the full run, on generated workbooks."""

import datetime as dt
import io
import json
import os
import time
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from storelens.catalog.workbooks import workbook_bytes
from storelens.operators import loads, state
from storelens.plans import ingest
from storelens.plans.full_run import refresh_kpis, run
from storelens.plans.transform import load_kpi_data, staged_sales
from storelens.sources import contracts as ct
from storelens.sources import files as fs
from storelens.sources.tables import Warehouse
from storelens.sources import workbook
from storelens.sources.workbook import Workbook, table_rows
from storelens.streaming.arrivals import tick, watch

D = dt.date
NOW = ingest.IngestOptions(stable_seconds=0)


def columns(**more):
    base = {
        "date": {"source_name": "Transaction Date", "data_type": "date", "validation_rules": {"not_null": True}},
        "product_id": {"source_name": "SKU", "data_type": "string"},
        "qty": {"source_name": "Qty Sold", "data_type": "integer", "validation_rules": {"min": -100, "max": 100000}},
        "revenue": {"source_name": "Net Sales", "data_type": "float", "validation_rules": {"min": -50000}},
        "customer_id": {"source_name": "Customer ID", "data_type": "string", "required": False, "default_value": "UNKNOWN"},
        "payment_method": {"source_name": "Payment Type", "data_type": "category", "required": False,
                           "validation_rules": {"allowed_values": ["CASH", "CREDIT"]}},
    }
    return {**base, **more}


def config():
    inventory = {"sheet_name": "Inventory_Levels", "columns": {
        "product_id": {"source_name": "SKU", "data_type": "string"},
        "stock_level": {"source_name": "Current Stock", "data_type": "integer", "validation_rules": {"min": 0}}}}
    sales = {"sheet_name": "regex:^(Sales_|销售_)", "skip_rows": 2, "columns": columns()}
    store = {"country": "JP", "region": "East", "lat": 35.68, "lon": 139.69, "sheets": {"sales_transactions": sales}}
    return {"stores": {
        "store_JP_001": {**store, "file_pattern": "store_JP_001_sales_*.xlsx",
                         "sheets": {"sales_transactions": sales, "inventory": inventory}},
        "store_CN_001": {**store, "country": "CN", "lat": 31.23, "lon": 121.47, "file_pattern": "store_CN_00[12]_sales_????.xlsx"},
        "store_any": {**store, "file_pattern": "store_*.xlsx"}}}


HEADER = ["Transaction Date", "SKU", "Qty Sold", "Net Sales", "Customer ID", "Payment Type"]


def sheet(rows):
    return [["Store report"], [], HEADER, *rows]


def good_rows(n=3, day=1):
    return [[D(2024, 1, day + i), f"SKU-{i}", -(i + 1) if i == 2 else i + 1, 10.5 * (i + 1), None if i else "C1", "CASH"]
            for i in range(n)]


@pytest.fixture
def inbox(tmp_path):
    d = tmp_path / "in"
    (d / "deep").mkdir(parents=True)
    return d


def put(path, sheets):
    path.write_bytes(sheets if isinstance(sheets, bytes) else workbook_bytes(sheets))


@pytest.fixture
def contracts():
    return ct.parse_contracts(config())


def fill(inbox):
    stock = [["SKU", "Current Stock"], ["SKU-1", 5], ["SKU-2", 7]]
    put(inbox / "store_JP_001_sales_1.xlsx", {"销售_2024": sheet(good_rows()), "Inventory_Levels": stock, "Notes": [["x"]]})
    put(inbox / "deep" / "store_CN_001_sales_2024.xlsx", {"Sales_2024": sheet(good_rows(2))})
    put(inbox / "copy_of.xlsx", {"Sales_2024": sheet(good_rows(2))})                                    # no contract
    put(inbox / "store_twin_of_cn.xlsx", {"Sales_2024": sheet(good_rows(2))})                           # equal content
    put(inbox / "store_9.xlsx", {"Sales_1": sheet(good_rows()), "Sales_2": sheet(good_rows())})          # two sheets fit
    put(inbox / "store_bad.xlsx", b"not a workbook" + b"\0" * 100)
    put(inbox / "store_cols.xlsx", {"Sales_1": [["a"], [], ["Wrong Date", "Product", "Amount"], [1, 2, 3]]})
    put(inbox / "store_empty.xlsx", {"Sales_1": []})
    put(inbox / "store_low.xlsx", {"Sales_1": sheet([[D(2024, 1, 1), "S", -500, 1.0, None, "BITCOIN"], *good_rows(1)])})
    # the store's second sheet is bad, the first survives
    put(inbox / "store_JP_001_sales_2.xlsx", {"Sales_2": sheet(good_rows(1, 9)),
                                              "Inventory_Levels": [["SKU", "Current Stock"], ["SKU-1", -5]]})


def test_workbook_cells():
    book = Workbook(workbook_bytes({"A": [["n", "t", "d", "b"], [1, "Ünï", dt.datetime(2024, 1, 2, 3, 4, 5), True], [],
                                          [2.5, None, None, None]]}))
    assert list(book.sheets) == ["A"]
    header, first, last = table_rows(book, "A", 0, 0)
    assert list(header) == ["n", "t", "d", "b"]
    assert first == {"n": ("n", "1"), "t": ("s", "Ünï"), "d": ("d", "2024-01-02 03:04:05"), "b": ("b", "true")}
    assert last["n"] == ("n", "2.5") and last["t"] is None


def with_sheet(xml):
    """A workbook whose only sheet is the given XML."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(workbook_bytes({"A": [["ab", "abcd"]]}))) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            new.writestr(name, xml if name.endswith("sheet1.xml") else old.read(name))
    return Workbook(out.getvalue())


def test_plain_rows_and_rows_of_other_forms_read_alike(monkeypatch):
    ns = workbook.MAIN[1:-1]
    plain = "".join(f'<row r="{n}" spans="1:5"><c r="A{n}" s="1"><v>{45000 + n}</v></c><c r="B{n}" t="s"><v>{n % 2}</v></c><c r="C{n}" s="1"/>'
                    f'<c r="D{n}" t="inlineStr"><is><t>x{n}</t></is></c><c r="AA{n}"><v>{n}.50</v></c></row>' for n in range(2, 2002) if n % 7)
    other = ('<row r="3000" ht="15"><c r="A3000" t="str"><f>1&lt;2</f><v>a &amp; b</v></c><!-- <row r="1"> --><c><v>7</v></c>'
             '<c t="inlineStr"><is><r><t>p</t></r><r><t>q</t></r></is></c><c r="F3000" t="b"><v>1</v></c><c r="G3000" t="e"><v>#N/A</v></c></row>'
             '<row><c r="B3001"><v>1e20</v></c></row>')
    tail = "".join(f'<row r="{n}"><c r="A{n}"><v>{n}</v></c></row>' for n in range(3005, 3007))
    xml = f'<worksheet xmlns="{ns}"><sheetData>{plain}{other}{tail}</sheetData><rowBreaks count="0"/></worksheet>'
    rows = list(with_sheet(xml).rows("A"))
    assert len(rows) == 3006 and rows[0] == rows[6] == rows[2998] == {}
    assert rows[8] == {1: ("d", "2023-03-24 00:00:00"), 2: ("s", "abcd"), 3: None, 4: ("s", "x9"), 27: ("n", "9.5")}
    assert rows[2999] == {1: ("s", "a & b"), 2: ("n", "7"), 3: ("s", "pq"), 6: ("b", "true"), 7: None}
    assert rows[3000] == {2: ("n", "1e+20")} and rows[3004:] == [{1: ("n", "3005")}, {1: ("n", "3006")}]
    prefixed = xml.replace("<", "<m:").replace("<m:/", "</m:").replace("<m:!--", "<!--").replace("xmlns=", "xmlns:m=")
    assert list(with_sheet(prefixed).rows("A")) == rows
    for broken in (xml[:-20], xml.replace("</sheetData>", ""), xml.replace("</row>" + tail, tail), xml[:len(plain) // 2]):
        with pytest.raises(ElementTree.ParseError):
            list(with_sheet(broken).rows("A"))
    parsed = []
    monkeypatch.setattr(workbook._Rows, "_start", lambda self, name, attributes: parsed.append(name))
    assert len(list(with_sheet(xml.replace(other, "")).rows("A"))) == 3006
    assert workbook.ROW not in parsed  # plain rows cost no call per element


def test_contract_files(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps(config()))
    loaded = ct.load_contracts(path)
    assert ct.list_stores(loaded) == ["store_JP_001", "store_CN_001", "store_any"]
    assert ct.get_contract(loaded, "store_CN_001").sheets[0].skip_rows == 2 and ct.get_contract(loaded, "x") is None
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yml").write_text(yaml.safe_dump(config(), sort_keys=False))
    assert ct.load_contracts(tmp_path / "c.yml") == loaded
    (tmp_path / "c.txt").write_text("")
    with pytest.raises(ValueError, match="unsupported"):
        ct.load_contracts(tmp_path / "c.txt")
    with pytest.raises(ValueError, match="unknown type"):
        ct.ColumnRule("a", "b", "money")


def test_globs_and_first_match(spark, contracts):
    names = ["store_JP_001_sales_x.xlsx", "store_CN_002_sales_2024.xlsx", "store_CN_003_sales_2024.xlsx",
             "other.xlsx", "store_CN_001_sales_20245.xlsx"]
    files = spark.createDataFrame([(f"file:/d/{n}",) for n in names], "path string")
    got = {r.path.split("/")[-1]: r.store_id for r in fs.match_contracts(files, ct.contracts_frame(spark, contracts)).collect()}
    assert [got[n] for n in names] == ["store_JP_001", "store_CN_001", "store_any", None, "store_any"]


def test_contracts_type_one_target_differently(spark):
    def store(kind, **rules):
        return {"country": "JP", "region": "R", "lat": 1, "lon": 1, "file_pattern": "x", "sheets": {"s": {"sheet_name": "a", "columns": {
            "qty": {"source_name": "q", "data_type": kind, "validation_rules": rules}}}}}
    cells = spark.createDataFrame([(s, "s", f"file-{s}", n, {"q": None if n == 0 else ("s", v)}) for s, vs in (
        ("whole", ["7", "-3", "1.5", "x"]), ("real", ["1.5", "2", "0.1", "x"]), ("text", ["1.5", "CASH"]), ("day", ["2024-01-02"]))
        for n, v in enumerate([None, *vs])], "store_id string, sheet_type string, source_file string, row_no long, cells map<string,struct<kind:string,text:string>>")

    def typed(*stores):
        book = ct.contracts_frame(spark, ct.parse_contracts({"stores": dict(stores)}))
        rows = ct.apply_contracts(cells, book, signed_integers=True)
        return dict(rows.dtypes)["qty"], {(r.store_id, r.row_no): (r.qty, r.violations) for r in rows.where("row_no > 0").collect()}
    whole, real = ("whole", store("integer", min=0)), ("real", store("float", min=1, max=1.9))
    kind, got = typed(whole, real)
    assert kind == "double" and [got["whole", n][0] for n in (1, 2, 3, 4)] == [7.0, -3.0, 1.0, None]
    assert [got["real", n] for n in (1, 2, 3)] == [(1.5, []), (2.0, ["qty:above_max"]), (0.1, ["qty:below_min"])]
    assert got["whole", 2][1] == ["qty:below_min"] and got["whole", 1][1] == []
    kind, got = typed(whole, real, ("text", store("category", allowed_values=["CASH"])), ("day", store("date")))
    assert kind == "string" and got["whole", 1][0] == "7" and got["real", 1][0] == "1.5" and got["day", 1][0] == "2024-01-02"
    assert got["text", 1] == ("1.5", ["qty:not_allowed"]) and got["text", 2] == ("CASH", []) and got["whole", 2][1] == ["qty:below_min"]
    assert typed(whole)[0] == "bigint"


def test_batch_ingest(spark, inbox, contracts, tmp_path):
    fill(inbox)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    results = {os.path.basename(r.source_file): r for r in
               ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b1", options=NOW).collect()}
    assert {n for n, r in results.items() if r.success} == {"store_JP_001_sales_1.xlsx", "store_CN_001_sales_2024.xlsx"}
    ok = results["store_JP_001_sales_1.xlsx"]
    assert ok.success and ok.sheets_extracted == ["inventory", "sales_transactions"] and ok.rows == 5
    partly = results["store_JP_001_sales_2.xlsx"]
    assert not partly.success and partly.sheets_extracted == ["sales_transactions"] and "stock_level" in partly.errors[0].error
    assert "several sheets" in results["store_9.xlsx"].errors[0].error
    assert "BadZipFile" in results["store_bad.xlsx"].errors[0].error
    assert "Transaction Date missing_column" in results["store_cols.xlsx"].errors[0].error
    assert "missing_column" in results["store_empty.xlsx"].errors[0].error
    assert "qty below_min in 1 rows" in results["store_low.xlsx"].errors[0].error

    staged = wh.read(ingest.STAGING)
    sold = staged.where("sheet_type = 'sales_transactions' and source_file like '%JP_001_sales_1.xlsx'").orderBy("ingest_ord").collect()
    assert [(r.date, r.qty, r.revenue, r.customer_id, r.country) for r in sold] == [
        (D(2024, 1, 1), 1, 10.5, "C1", "JP"), (D(2024, 1, 2), 2, 21.0, "UNKNOWN", "JP"), (D(2024, 1, 3), -3, 31.5, "UNKNOWN", "JP")]
    assert staged.where("sheet_type = 'inventory'").select("stock_level").distinct().count() == 2
    letters = wh.read(ingest.DEAD_LETTERS, state.DEAD_LETTER_SCHEMA)
    assert letters.where("error_type = 'NoMatchingContract'").count() == 1
    assert letters.where("error_type = 'SheetRejected'").count() == 6
    assert letters.where("content is null").count() == 0
    stats = state.event_statistics(wh.read(ingest.STATE, state.STATE_SCHEMA)).first()
    assert (stats.total_processed, stats.failed) == (3, 5)
    assert wh.read(ingest.MANIFEST).agg(F.sum("row_count")).first()[0] == staged.count()
    written = wh.read(ingest.STAGED_FILES).collect()
    assert {(r.store_id, r.sheet_type) for r in written} == {(r.store_id, r.sheet_type) for r in staged.select("store_id", "sheet_type").distinct().collect()}
    assert all(r.bytes == os.path.getsize(r.path.removeprefix("file:")) for r in written)

    # nothing new: finished files are skipped, failed ones are tried again
    before = staged.count()
    again = ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b2", options=NOW)
    assert again.where("success").count() == 0
    assert wh.read(ingest.STAGING).count() == before
    # the same batch again replaces its own output
    ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b1", options=NOW)
    assert wh.read(ingest.STAGING).count() == before

    # repaired files leave the dead letters
    put(inbox / "store_low.xlsx", {"Sales_1": sheet(good_rows(1, 20))})
    (inbox / "store_bad.xlsx").unlink()
    ingest.run_ingest(spark, str(inbox), contracts, wh, mode="reprocess-dlq", batch_id="b3", options=NOW)
    resolved = wh.read(ingest.RESOLUTIONS, state.RESOLUTION_SCHEMA)
    status = state.failure_status(wh.read(ingest.DEAD_LETTERS, state.DEAD_LETTER_SCHEMA).where("batch_id = 'b1'"), resolved)
    outcome = {os.path.basename(r.file_path): r.outcome for r in status.collect()}
    assert outcome["store_low.xlsx"] == "SUCCESS" and outcome["store_cols.xlsx"] == "FAILED"
    assert outcome["store_bad.xlsx"] == "PENDING"


def test_row_level_rejection(spark, inbox, contracts, tmp_path):
    put(inbox / "store_low.xlsx", {"Sales_1": sheet([[D(2024, 1, 1), "S", -500, 1.0, None, "CASH"], *good_rows(2)])})
    put(inbox / "store_cols.xlsx", {"Sales_1": [["a"], [], HEADER[1:], ["S", 1, 2.0, None, None]]})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    options = ingest.IngestOptions(reject="row", stable_seconds=0)
    got = {os.path.basename(r.source_file): r for r in
           ingest.run_ingest(spark, str(inbox), contracts, wh, options=options).collect()}
    assert got["store_low.xlsx"].success and got["store_low.xlsx"].rows == 2
    assert not got["store_cols.xlsx"].success
    assert wh.read(ingest.STAGING).count() == 2


def test_young_files_wait(spark, inbox, contracts, tmp_path):
    put(inbox / "store_x.xlsx", {"Sales_1": sheet(good_rows(1))})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    late = ingest.IngestOptions(stable_seconds=3600)
    assert ingest.run_ingest(spark, str(inbox), contracts, wh, options=late).count() == 0


def key(wh):
    staged = wh.read(ingest.STAGING).select(F.substring_index("source_file", "/", -1).alias("f"), "row_no", "date", "qty")
    return sorted(tuple(r) for r in staged.collect())


def test_ticks_equal_one_batch_and_see_modified_files(spark, inbox, contracts, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "ticks"))
    put(inbox / "store_a.xlsx", {"Sales_1": sheet(good_rows(1))})
    tick(spark, str(inbox), contracts, wh, "t1", options=NOW)
    put(inbox / "store_b.xlsx", {"Sales_1": sheet(good_rows(2, 4))})
    tick(spark, str(inbox), contracts, wh, "t2", options=NOW)
    tick(spark, str(inbox), contracts, wh, "t3", options=NOW)
    one = Warehouse(spark, str(tmp_path / "one"))
    ingest.run_ingest(spark, str(inbox), contracts, one, options=NOW)
    assert key(wh) == key(one) and len(key(wh)) == 3
    put(inbox / "store_a.xlsx", {"Sales_1": sheet(good_rows(3, 10))})
    tick(spark, str(inbox), contracts, wh, "t4", options=NOW)
    assert len(key(wh)) == 6
    # an old file whose time stamp lies before the last tick is not listed again
    old = time.time() - 3600
    put(inbox / "store_c.xlsx", {"Sales_1": sheet(good_rows(1, 25))})
    os.utime(inbox / "store_c.xlsx", (old, old))
    assert tick(spark, str(inbox), contracts, wh, "t5", options=NOW).count() == 0


def test_file_stream(spark, inbox, contracts, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for i in range(2):
        put(inbox / f"store_{i}.xlsx", {"Sales_1": sheet(good_rows(1, 1 + i))})
        q = watch(spark, str(inbox), contracts, wh, source="file-stream", options=NOW, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None
    assert len(key(wh)) == 2


def test_clock_stream_ingests_what_appears(spark, inbox, contracts, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    put(inbox / "store_a.xlsx", {"Sales_1": sheet(good_rows(2))})
    q = watch(spark, str(inbox), contracts, wh, every="1 second", options=NOW)
    try:
        end = time.time() + 180
        while time.time() < end and q.exception() is None and not wh.exists("ingest_ticks"):
            time.sleep(1)
        assert q.exception() is None
    finally:
        q.stop()
    # a tick that was cut off by the stop repeats in place; finished ones counted each row once
    finished = wh.read(ingest.STATE, state.STATE_SCHEMA).select("batch_id").distinct()
    staged = wh.read(ingest.STAGING).join(finished, "batch_id", "left_semi")
    assert staged.count() == 2


def test_snapshots_and_store_loads(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(FileNotFoundError):
        wh.read_snapshot("stores")
    first = spark.createDataFrame([("a", "JP"), ("b", "JP"), ("b", "JP")], "store_id string, country string")
    assert loads.load_stores(wh, first) == 2
    second = spark.createDataFrame([("b", "CN"), ("c", "CN")], "store_id string, country string")
    loads.load_stores(wh, second, "append")
    assert {tuple(r) for r in wh.read_snapshot("stores").collect()} == {("a", "JP"), ("b", "JP"), ("c", "CN")}
    loads.load_stores(wh, second, "upsert")
    assert {tuple(r) for r in wh.read_snapshot("stores").collect()} == {("a", "JP"), ("b", "CN"), ("c", "CN")}
    # an unfinished snapshot is not read
    os.makedirs(f"{wh.path('stores')}/snapshot_id=99999999T000000")
    assert wh.read_snapshot("stores").count() == 3
    loads.load_stores(wh, second, "replace")
    assert wh.read_snapshot("stores").count() == 2
    assert wh.read("load_history").count() == 4
    with pytest.raises(ValueError):
        loads.load_stores(wh, second, "merge")


def test_kpi_and_csv_writes(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    def day(d, v):
        return spark.createDataFrame([("a", d, v)], "store_id string, calculation_date date, revenue_mtd double")
    loads.load_kpis(wh, day(D(2024, 1, 1), 1.0))
    loads.load_kpis(wh, day(D(2024, 1, 2), 2.0))
    loads.load_kpis(wh, day(D(2024, 1, 1), 3.0))
    got = spark.read.parquet(wh.path("store_kpis"))
    assert sorted(r.revenue_mtd for r in got.collect()) == [2.0, 3.0]
    loads.export_csv(got, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["store_id", "revenue_mtd", "calculation_date"]


def test_full_run(spark, inbox, tmp_path):
    path = tmp_path / "contracts.json"
    path.write_text(json.dumps(config()))
    empty = run(spark, str(path), str(inbox), str(tmp_path / "empty"), reference_date=D(2024, 1, 31), options=NOW)
    assert empty == {"files": 0, "rows": 0}
    put(inbox / "store_JP_001_sales_1.xlsx", {"Sales_1": sheet(good_rows(3)), "Inventory_Levels": [["SKU", "Current Stock"]]})
    put(inbox / "store_CN_001_sales_2024.xlsx", {"Sales_1": sheet(good_rows(2))})
    root = str(tmp_path / "wh")
    done = run(spark, str(path), str(inbox), root, reference_date=D(2024, 1, 31), run_id="r1", options=NOW)
    assert done == {"files": 2, "rows": 5}
    wh = Warehouse(spark, root)
    kpis = {r.store_id: r for r in spark.read.parquet(wh.path("store_kpis")).collect()}
    assert abs(kpis["store_JP_001"].revenue_mtd - 63.0 * 0.0067) < 1e-3 and kpis["store_CN_001"].rank_in_region == 1
    assert wh.read_snapshot("kpi_markers").count() == 2
    assert not refresh_kpis(wh, D(2024, 1, 31)) and refresh_kpis(wh, D(2024, 1, 31), force=True)
    summary = {r.economic_region: r for r in spark.read.parquet(wh.path("regional_summaries")).collect()}
    assert summary["Greater China"].currency_exposure.keys() == {"CNY"}
    assert load_kpi_data(wh).count() == 2 and staged_sales(wh, since=D(2020, 1, 1)).count() == 5
    assert staged_sales(wh, since=D(2999, 1, 1)).count() == 0
    # nothing new in the second run; new sales add to the loaded ones
    assert run(spark, str(path), str(inbox), root, reference_date=D(2024, 1, 31), run_id="r2", options=NOW)["rows"] == 0
    put(inbox / "store_CN_002_sales_2025.xlsx", {"Sales_1": sheet(good_rows(1, 15))})
    run(spark, str(path), str(inbox), root, reference_date=D(2024, 1, 31), run_id="r3", options=NOW)
    assert wh.read("sales_transactions").count() == 6


def cut_off(content, sheet_no, keep):
    """The workbook with one sheet's XML broken off after a share of its bytes."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            data = old.read(name)
            new.writestr(name, data[:int(len(data) * keep)] if name.endswith(f"sheet{sheet_no}.xml") else data)
    return out.getvalue()


def many_rows(n):
    return [[D(2024, 1, 1 + i % 28), f"SKU-{i}", 1, 1.0, "C1", "CASH"] for i in range(n)]


def test_rows_of_a_broken_sheet_are_not_staged(spark, inbox, contracts, tmp_path):
    put(inbox / "store_cut.xlsx", cut_off(workbook_bytes({"Sales_1": sheet(many_rows(60))}), 1, 0.7))
    put(inbox / "store_fine.xlsx", {"Sales_1": sheet(good_rows(2))})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for batch in ("b1", "b2"):
        got = {os.path.basename(r.source_file): r for r in ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id=batch, options=NOW).collect()}
        assert not got["store_cut.xlsx"].success and got["store_cut.xlsx"].rows == 0
        assert wh.read(ingest.STAGING).count() == 2
    assert staged_sales(wh).count() == 2


def test_a_repeated_batch_replaces_other_partitions_too(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for day in ("2024-01-01", "2024-01-02"):
        wh.append("staging", spark.range(10).withColumn("extraction_date", F.lit(day)), "b1", ("extraction_date",))
    assert wh.read("staging").count() == 10


def test_a_file_that_fails_twice_is_pending_again(spark, inbox, contracts, tmp_path):
    put(inbox / "store_low.xlsx", {"Sales_1": sheet([[D(2024, 1, 1), "S", -500, 1.0, None, "CASH"]])})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ingest.run_ingest(spark, str(inbox), contracts, wh, batch_id="b1", options=NOW)
    for batch in ("b2", "b3"):
        ingest.run_ingest(spark, str(inbox), contracts, wh, mode="reprocess-dlq", batch_id=batch, options=NOW)
        pending = state.pending_failures(wh.read(ingest.DEAD_LETTERS, state.DEAD_LETTER_SCHEMA), wh.read(ingest.RESOLUTIONS, state.RESOLUTION_SCHEMA))
        assert [r.batch_id for r in pending.collect()] == [batch]


def summary_of(spark, wh):
    rows = spark.read.parquet(wh.path("regional_summaries")).collect()
    newest = {}
    for r in sorted(rows, key=lambda r: r.period_end):
        newest[r.economic_region] = (round(r.total_revenue_usd, 6), r.total_stores, r.total_transactions)
    return newest


def test_lost_runs_edits_and_summaries(spark, inbox, tmp_path):
    path = tmp_path / "contracts.json"
    path.write_text(json.dumps(config()))
    args = dict(reference_date=D(2024, 1, 31), options=NOW)
    put(inbox / "store_CN_001_sales_2024.xlsx", {"Sales_1": sheet(good_rows(2))})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    # the first run ends after its ingest; the next one finds nothing new to ingest and loads what was left
    tick(spark, str(inbox), ct.load_contracts(str(path)), wh, "lost", options=NOW)
    assert run(spark, str(path), str(inbox), wh.root, run_id="r1", **args) == {"files": 0, "rows": 2}
    assert run(spark, str(path), str(inbox), wh.root, run_id="r2", **args)["rows"] == 0
    # sales of a load that was cut off before it was marked count for nobody
    loads.load_sales(wh, wh.read("sales_transactions", loads.SALES_SCHEMA).drop("batch_id", "month"), "cut-off")
    # a second store, then an edited file: all figures cover all current sales once
    put(inbox / "store_CN_002_sales_2025.xlsx", {"Sales_1": sheet(good_rows(1, 8))})
    run(spark, str(path), str(inbox), wh.root, run_id="r3", **args)
    put(inbox / "store_CN_001_sales_2024.xlsx", {"Sales_1": sheet(good_rows(3, 5))})
    assert run(spark, str(path), str(inbox), wh.root, run_id="r4", **args)["rows"] == 3
    once = Warehouse(spark, str(tmp_path / "once"))
    assert run(spark, str(path), str(inbox), once.root, run_id="r1", **args)["rows"] == 4
    assert staged_sales(wh).count() == staged_sales(once).count() == 4
    assert summary_of(spark, wh) == summary_of(spark, once)
    kpis = [sorted((r.store_id, r.revenue_mtd) for r in load_kpi_data(w).collect()) for w in (wh, once)]
    assert kpis[0] == kpis[1]


def test_several_directories_and_no_leftovers(spark, inbox, contracts, tmp_path):
    from storelens.functions.materialize import ensure_checkpoint_dir
    other = tmp_path / "more"
    other.mkdir()
    put(inbox / "store_a.xlsx", {"Sales_1": sheet(good_rows(1))})
    put(other / "store_b.xlsx", {"Sales_1": sheet(good_rows(2, 4))})
    wh = Warehouse(spark, str(tmp_path / "wh"))

    def tables():
        root = ensure_checkpoint_dir(spark).removeprefix("file:")
        return {d for d in os.listdir(root) if not d.startswith("rdd-")}
    before = tables()
    where = [str(inbox), str(other)]
    assert tick(spark, where, contracts, wh, "t1", options=NOW).count() == 2
    entries = sorted(os.walk(wh.root))
    for n in range(2, 4):  # nothing new: nothing is written
        assert tick(spark, where, contracts, wh, f"t{n}", options=NOW).count() == 0
    assert sorted(os.walk(wh.root)) == entries
    assert tables() == before
