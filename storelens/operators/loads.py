"""Loading stores, sales and KPIs into the warehouse, and the load history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.money import exact_sum
from ..sources.tables import Warehouse

# Columns of the persisted tables.
STORE_COLUMNS = ("store_id", "country", "region", "economic_region", "urban_rural", "latitude", "longitude",
                 "nearest_city", "distance_to_city_km", "cluster_id", "stores_within_10km",
                 "gdp_per_capita_usd", "urbanization_rate")
SALES_COLUMNS = ("store_id", "date", "product_id", "qty", "revenue", "original_currency", "revenue_usd",
                 "exchange_rate_usd", "is_interpolated")
SALES_SCHEMA = ("store_id string, date date, product_id string, qty bigint, revenue double, original_currency string, "
                "revenue_usd double, exchange_rate_usd double, is_interpolated boolean, month string, "
                "source_file string, staged_batch string")
LINEAGE = ("source_file", "staged_batch")
LOADED, LOADED_SCHEMA = "loaded_files", "source_file string, staged_batch string"
# mergeable sums of the loaded sales: one slice per file version, which counts as long as the version does
DAY_SUMS, DAY_KEYS = "sales_day_sums", ("store_id", "date", "original_currency")
DAY_SUMS_SCHEMA = ("store_id string, date date, original_currency string, usd decimal(38,10), n_usd bigint, n bigint, "
                   "qty bigint, n_qty bigint, source_file string, staged_batch string")
LOAD_MODES = ("replace", "upsert", "append")


def store_rows(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Known store columns, one row per store: the first in ``order_by``, else any."""
    present = [c for c in STORE_COLUMNS if c in df.columns]
    if order_by is None:
        return df.select(*present).dropDuplicates(["store_id"])
    rest = F.struct(*[c for c in present if c != "store_id"])
    return df.groupBy("store_id").agg(F.min_by(rest, order_by).alias("_r")).select("store_id", "_r.*").select(*present)


def merge_stores(target: DataFrame, source: DataFrame, mode: str = "upsert") -> DataFrame:
    """The new state of the stores table: upsert replaces whole rows, append keeps existing ones."""
    if mode not in LOAD_MODES:
        raise ValueError(f"mode must be one of {LOAD_MODES}")
    if mode == "replace":
        return source
    keep, add = (target, source) if mode == "append" else (source, target)
    new = add.join(keep.select("store_id"), "store_id", "left_anti")
    return keep.unionByName(new, allowMissingColumns=True)


def record_load(wh: Warehouse, table: str, rows: int, mode: str, load_id: str) -> None:
    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    entry = wh.spark.createDataFrame([(table, rows, mode, at)], "table string, rows bigint, mode string, loaded_at timestamp_ntz")
    wh.append("load_history", entry, f"{load_id}-{table}")


def load_stores(wh: Warehouse, df: DataFrame, mode: str = "upsert", order_by: str | None = None) -> int:
    """Write a new snapshot of ``stores``; returns the number of rows offered."""
    source = store_rows(df, order_by)
    target = wh.read_snapshot("stores", fallback=source.limit(0))
    snapshot = wh.write_snapshot("stores", merge_stores(target, source, mode))
    rows = source.count()
    record_load(wh, "stores", rows, mode, snapshot)
    return rows


def load_sales(wh: Warehouse, df: DataFrame, load_id: str) -> int:
    """Append sales under ``load_id``, partitioned by month so date filters prune files."""
    present = [c for c in (*SALES_COLUMNS, *LINEAGE) if c in df.columns]
    rows = df.select(*present).withColumn("month", F.date_format("date", "yyyy-MM"))
    if "qty" in present:
        rows = rows.withColumn("qty", F.col("qty").cast("bigint"))
    written = Observation()
    wh.append("sales_transactions", rows.observe(written, F.count(F.lit(1)).alias("rows")), load_id, ("month",))
    n = written.get["rows"]  # counted by the write itself
    record_load(wh, "sales_transactions", n, "append", load_id)
    return n


def day_sums(sales: DataFrame) -> DataFrame:
    """Sales as exact sums per file version, store, day and currency: whatever adds up, adds up from these."""
    qty = F.col("qty").cast("bigint") if "qty" in sales.columns else F.lit(None).cast("bigint")
    return sales.groupBy(*[c for c in LINEAGE if c in sales.columns], *DAY_KEYS).agg(
        exact_sum("revenue_usd").alias("usd"), F.count("revenue_usd").alias("n_usd"), F.count(F.lit(1)).alias("n"),
        F.sum(qty).alias("qty"), F.count(qty).alias("n_qty"))


def load_day_sums(wh: Warehouse, sales: DataFrame, load_id: str) -> None:
    """The slices of the file versions that a load holds."""
    wh.append(DAY_SUMS, day_sums(sales), load_id)


def mark_loaded(wh: Warehouse, files: DataFrame, load_id: str) -> None:
    """Record the file versions (source_file, staged_batch) that a load holds. Written after its sales, so the sales
    of a load that was cut off belong to no one and are loaded again."""
    wh.append(LOADED, files.select(*LINEAGE), load_id)


def loaded_versions(wh: Warehouse, current: DataFrame) -> DataFrame:
    """(batch_id of the load, source_file, staged_batch) of complete loads that hold a ``current`` version (source_file,
    batch_id) of a file."""
    return wh.read(LOADED, LOADED_SCHEMA).join(
        current.select("source_file", F.col("batch_id").alias("staged_batch")), [*LINEAGE], "left_semi")


def loaded_sales(wh: Warehouse, current: DataFrame) -> DataFrame:
    """The sales of complete loads, of the ``current`` version of each file."""
    sales = wh.read("sales_transactions", SALES_SCHEMA)
    return sales.join(loaded_versions(wh, current), ["batch_id", *LINEAGE], "left_semi")


def loaded_day_sums(wh: Warehouse, current: DataFrame) -> DataFrame:
    """:func:`loaded_sales` as sums by store, day and currency, from the stored slices; no sale is read."""
    slices = wh.read(DAY_SUMS, DAY_SUMS_SCHEMA).join(loaded_versions(wh, current), ["batch_id", *LINEAGE], "left_semi")
    return slices.groupBy(*DAY_KEYS).agg(*[F.sum(c).cast(t).alias(c) for c, t in (
        ("usd", "decimal(38,10)"), ("n_usd", "bigint"), ("n", "bigint"), ("qty", "bigint"), ("n_qty", "bigint"))])


def load_kpis(wh: Warehouse, kpis: DataFrame) -> None:
    """Replace the rows of the calculation dates in ``kpis`` and keep all others."""
    (kpis.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("calculation_date").parquet(wh.path("store_kpis")))


def load_regional_summaries(wh: Warehouse, summary: DataFrame) -> None:
    """Regional records by period end; lists and maps stay nested columns."""
    rows = summary.withColumn("period", F.col("period_end").cast("date"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("period").parquet(wh.path("regional_summaries")))


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
