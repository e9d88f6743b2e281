"""Base frames of the checked queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.joins import join_dimension
from ..operators import fx, geo
from ..sources import retail_tables as rt

REFERENCE_DATE = dt.date(2000, 6, 30)


def r(c: str | Column, digits: int = 6) -> Column:
    """A ratio rounded for comparison, under its own name."""
    return F.round(F.col(c), digits).alias(c) if isinstance(c, str) else F.round(c, digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def located_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores with country context, nearest city and urban class."""
    return geo.with_location_class(rt.stores(spark, sf_dir))


STORE_COLUMNS = ("store_id", "country", "economic_region", "urban_rural", "nearest_city",
                 "latitude", "longitude", "gdp_per_capita_usd")


def usd_sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Sales with store context and USD amounts; ``columns`` names the store columns wanted."""
    wanted = list(dict.fromkeys(["store_id", "country", *(columns or STORE_COLUMNS)]))
    stores = located_stores(spark, sf_dir).select(*wanted)
    return fx.normalize(join_dimension(rt.sales(spark, sf_dir), stores, ["store_id"], "inner"))


def usd_sales_until(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return usd_sales(spark, sf_dir, *columns).where(F.col("date") <= F.lit(REFERENCE_DATE))
