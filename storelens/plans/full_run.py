"""The whole run: ingest, transform, load, KPIs. Entry point of the daily job."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import join_dimension
from ..functions.materialize import intermediates_deleted, stored
from ..operators import aggregate, clean, kpi, loads
from ..sources.contracts import contracts_frame, load_contracts
from ..sources.tables import Warehouse
from ..streaming.arrivals import tick
from .ingest import IngestOptions
from .transform import Transformed, current_versions, staged_sales, transform

KPI_AGE = dt.timedelta(hours=1)
COUNTED = "figured_versions"


def refresh_kpis(
    wh: Warehouse, reference_date, *, force: bool = False, now: dt.datetime | None = None,
) -> bool:
    """Recompute KPI records, markers and region summary from the stored sums of the loaded sales.

    Skipped when the last refresh is younger than an hour, unless forced. Returns whether it ran.
    """
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    done = wh.snapshots("kpi_records")
    if done and not force:
        last = dt.datetime.strptime(done[-1], "%Y%m%dT%H%M%S%f")
        if now - last < KPI_AGE:
            return False
    snapshot = now.strftime("%Y%m%dT%H%M%S%f")
    records = kpi.calculate_store_kpis(
        loads.loaded_day_sums(wh, current_versions(wh)), reference_date, stores=wh.read_snapshot("stores"), days=True)
    wh.write_snapshot("kpi_records", records, snapshot)
    records = wh.read_snapshot("kpi_records")
    wh.write_snapshot("kpi_markers", kpi.marker_rows(records), snapshot)
    wh.write_snapshot("kpi_region_summary", kpi.region_summary(records), snapshot)
    return True


def load(wh: Warehouse, result: Transformed, files: DataFrame, load_id: str) -> None:
    """Stores, sales and the sums by day of ``files`` (source_file, staged_batch)."""
    loads.load_stores(wh, result.enriched, order_by="ingest_ord")
    loads.load_sales(wh, result.cleaned, load_id)
    loads.load_day_sums(wh, result.cleaned, load_id)
    loads.mark_loaded(wh, files, load_id)


def refresh_figures(wh: Warehouse, reference_date) -> None:
    """KPI table, regional summaries and KPI records over all sales that count now, from the stored sums by day.

    The sums of a file version that was replaced no longer count, those of one that came back count again; no sale is
    read. The versions counted are written last.
    """
    stores = wh.read_snapshot("stores")
    days = stored(loads.loaded_day_sums(wh, current_versions(wh)), "days")
    loads.load_kpis(wh, kpi.store_kpi_table(stores, days, reference_date, days=True))
    places = stores.select("store_id", "economic_region", "urban_rural", "stores_within_10km")
    summary = stored(aggregate.full_regional_summary(join_dimension(days, places, ["store_id"]), days=True), "summary")
    loads.load_regional_summaries(wh, summary)  # by period, earlier ones stay
    wh.write_snapshot("regional_summary", summary)  # what holds now
    refresh_kpis(wh, reference_date, force=True)
    wh.write_snapshot(COUNTED, loads.loaded_versions(wh, current_versions(wh)).select(*loads.LINEAGE))


def figures_are_current(wh: Warehouse) -> bool:
    """Whether the figures cover exactly the loaded versions that count now."""
    now = loads.loaded_versions(wh, current_versions(wh)).select(*loads.LINEAGE)
    counted = wh.read_snapshot(COUNTED, fallback=now.limit(0))
    return now.subtract(counted).isEmpty() and counted.subtract(now).isEmpty()


def run(
    spark: SparkSession, contracts_path: str, incoming: str, root: str, *, reference_date=None,
    run_id: str | None = None, rates: DataFrame | None = None, options: IngestOptions = IngestOptions(),
) -> dict[str, int]:
    """One full run over the files that are new; repeating a ``run_id`` repeats its writes in place.

    Only the sales of new file versions are transformed and appended. KPIs come from the stored sums of all loaded
    sales, and neighbours are counted among all stores under contract, so the figures cover everything loaded so far.
    They are made anew whenever the versions that count have changed, also when a file went back to an earlier content.
    """
    wh = Warehouse(spark, root)
    reference_date = reference_date or dt.date.today()
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    with intermediates_deleted(spark):
        return _run(wh, contracts_path, incoming, reference_date, run_id, rates, options)


def _run(wh: Warehouse, contracts_path: str, incoming: str, reference_date, run_id: str, rates: DataFrame | None,
         options: IngestOptions) -> dict[str, int]:
    spark = wh.spark
    contracts = load_contracts(contracts_path)
    results = tick(spark, incoming, contracts, wh, run_id, options=options)
    extracted = results.count()
    # file versions that no complete load holds, also those of a run that ended after its ingest
    held = wh.read(loads.LOADED, loads.LOADED_SCHEMA).where(F.col("batch_id") != run_id).select(*loads.LINEAGE)
    new = stored(current_versions(wh).withColumnRenamed("batch_id", "staged_batch").join(
        held, [*loads.LINEAGE], "left_anti"), "new-versions")
    sales = staged_sales(wh).withColumnRenamed("batch_id", "staged_batch").join(new, [*loads.LINEAGE], "left_semi")
    rows = 0
    if not sales.isEmpty():
        config = clean.CleanConfig(keep_case=(*loads.LINEAGE, "economic_region", "urban_rural"))
        stores = contracts_frame(spark, contracts)
        result = transform(sales, rates=rates, config=config, stores=stores, save_to=wh)
        load(wh, result, new, run_id)
        rows = result.cleaned.count()
    if not figures_are_current(wh):
        refresh_figures(wh, reference_date)
    return {"files": extracted, "rows": rows}


def main(argv: list[str] | None = None) -> None:
    from ..session import session
    parser = argparse.ArgumentParser(description="ingest new workbooks, transform, load, refresh KPIs")
    for name in ("contracts", "incoming", "warehouse"):
        parser.add_argument(name)
    parser.add_argument("--reference-date", type=dt.date.fromisoformat)
    parser.add_argument("--run-id")
    args = parser.parse_args(argv)
    print(run(session("storelens-daily"), args.contracts, args.incoming, args.warehouse,
              reference_date=args.reference_date, run_id=args.run_id))


if __name__ == "__main__":
    main()
