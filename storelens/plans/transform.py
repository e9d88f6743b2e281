"""Transform: geography, currency, cleaning, regional series, same-store growth."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..functions.joins import join_dimension
from ..functions.materialize import stored
from ..operators import aggregate, clean, fx, geo
from ..operators.state import STATE_SCHEMA, VERSION_SCHEMA, current_contents
from ..sources.tables import Warehouse


@dataclass(frozen=True)
class Transformed:
    enriched: DataFrame
    normalized: DataFrame
    cleaned: DataFrame
    make_report: Callable[[], DataFrame]
    regional_summary: DataFrame
    same_store_sales: DataFrame

    @cached_property
    def quality_report(self) -> DataFrame:
        """Made when it is first asked for: it reads all rows several times."""
        return self.make_report()


def transform(
    df: DataFrame, *, reporting: str = "USD", rates: DataFrame | None = None,
    config: clean.CleanConfig = clean.CleanConfig(keep_case=("source_file", "economic_region", "urban_rural")),
    distance: str = "haversine", grain: str = "store", stores: DataFrame | None = None,
    save_to: Warehouse | None = None,
) -> Transformed:
    """All five steps. ``cleaned`` is stored once, because the aggregates and the loads read it.

    With ``stores`` (store_id, latitude, longitude, country of every store) neighbours are counted
    among all of them, even when ``df`` holds the sales of a few.

    With ``save_to`` each step is also kept as a snapshot named after it. The default keeps the
    case of region and urban class; pass a config without them for upper-case names.
    """
    if stores is None:
        enriched = geo.enrich(df, distance=distance, grain=grain)
    else:
        known = geo.enrich(stores.select(*geo.REQUIRED), distance=distance)
        enriched = join_dimension(df.drop(*geo.REQUIRED[1:]), known, ["store_id"])
    normalized = fx.normalize(enriched, reporting=reporting, rates=rates)
    cleaned, make_report = clean.clean_steps(normalized, config)
    cleaned = stored(cleaned, "cleaned")
    out = Transformed(enriched, normalized, cleaned, make_report, aggregate.aggregate_by_region(cleaned),
                      aggregate.same_store_sales(cleaned, order_by=[config.order_by]))
    if save_to is not None:
        for name, frame in {
                "enriched": out.enriched, "normalized": out.normalized, "cleaned": out.cleaned, "quality_report": out.quality_report,
                "regional_aggregation": out.regional_summary, "same_store_sales": out.same_store_sales}.items():
            save_to.write_snapshot(name, frame)
    return out


# Columns of a staged sale; a contract's further columns stay in the staging files.
STAGED_SALES = (
    "source_file string, row_no bigint, customer_id string, date date, payment_method string, product_id string, "
    "qty bigint, revenue double, country string, region string, latitude double, longitude double, "
    "extraction_timestamp timestamp, ingest_ord string, store_id string, extraction_date date, sheet_type string")


def current_versions(wh: Warehouse) -> DataFrame:
    """(source_file, batch_id): what the newest finished version of each file holds, from the batch that extracted it.

    An edited file replaces what it held before; one that is changed back shows its first extraction again.
    """
    return current_contents(wh.read("file_versions", VERSION_SCHEMA), wh.read("extraction_state", STATE_SCHEMA))


def staged_sales(wh: Warehouse, *, since=None, sheet_type: str = "sales_transactions") -> DataFrame:
    """The staged sales of each file's newest finished batch; ``since`` prunes the extraction dates before any file is read."""
    staged = wh.read("staging", STAGED_SALES).where(F.col("sheet_type") == sheet_type)
    if since is not None:
        staged = staged.where(F.col("extraction_date") >= F.lit(since))
    return staged.join(current_versions(wh), ["source_file", "batch_id"], "left_semi")


def load_kpi_data(wh: Warehouse) -> DataFrame:
    """The persisted KPI table."""
    return wh.spark.read.parquet(wh.path("store_kpis"))


def latest_or_test_data(wh: Warehouse, fallback: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The newest enriched and cleaned snapshots, or the fallback for both."""
    return wh.read_snapshot("enriched", fallback), wh.read_snapshot("cleaned", fallback)
