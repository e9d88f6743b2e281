"""The star-schema tables seen as stores and sales.

``supplier`` gives the stores, ``lineitem`` (with ``orders``) the sales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import dimensions as dim

ORDER_COLUMN = "ingest_ord"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store_key(number) -> F.Column:
    return F.concat(F.lit("store_"), F.lpad(number.cast("string"), 6, "0"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(store_id, store_name, country, latitude, longitude, s_suppkey)."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    cities = F.broadcast(dim.cities(spark))  # 29 literal rows
    spread = F.when(key % 3 == 0, F.lit(1000.0)).otherwise(F.lit(200.0))
    away = F.when(key % 10 == 9, F.lit(2.0)).when(key % 10 == 8, F.lit(4.0)).otherwise(F.lit(0.0))
    country = (F.when(key % 17 == 16, "US")
               .when((F.col("ord") == 8) & (key % 2 == 1), "HK").otherwise(F.col("country")))
    return s.join(cities, (F.col("s_nationkey") + key) % len(dim.CITIES) == F.col("ord")).select(
        store_key(key).alias("store_id"), F.col("s_name").alias("store_name"), country.alias("country"),
        (F.col("city_lat") + ((key * 37) % 101 - 50) / spread + away).alias("latitude"),
        (F.col("city_lon") + ((key * 53) % 101 - 50) / spread).alias("longitude"),
        "s_suppkey")


def sales(spark: SparkSession, sf_dir: str, *, with_orders: bool = False) -> DataFrame:
    """(store_id, date, product_id, qty, revenue[, customer_id, payment_method], ingest_ord).

    Amounts are computed in whole ten-thousandths and handed out as doubles. ``ingest_ord`` is a total order;
    without ``orders`` no join is made.
    """
    li = table(spark, sf_dir, "lineitem")
    cents, percent = (F.floor(F.col(c) * 100 + 0.5) for c in ("l_extendedprice", "l_discount"))
    back = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    net = cents * (100 - percent)
    # order, line, part and supplier number side by side in one sortable decimal
    ordered = F.expr(
        "cast(cast(l_orderkey as decimal(15,0)) * 10000000000000000000000BD"
        " + cast(l_linenumber as decimal(1,0)) * 1000000000000000000000BD"
        " + cast(l_partkey as decimal(11,0)) * 10000000000BD + l_suppkey as decimal(38,0))")
    columns = [
        store_key(F.col("l_suppkey")).alias("store_id"),
        F.to_date("l_shipdate").alias("date"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("l_partkey").cast("string"), 5, "0")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        (F.when(back, -net).otherwise(net) / 10000.0).alias("revenue"),
    ]
    if with_orders:
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        li = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        methods = F.create_map(*[F.lit(x) for pair in (
            ("1", "CASH"), ("2", "CREDIT"), ("3", "DEBIT"), ("4", "MOBILE"), ("5", "E-WALLET")) for x in pair])
        columns += [
            F.concat(F.lit("CUST-"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("customer_id"),
            F.try_element_at(methods, F.substring("o_orderpriority", 1, 1)).alias("payment_method"),
        ]
    return li.select(*columns, ordered.alias(ORDER_COLUMN))
