"""Reference dimensions: cities, countries, fixed exchange rates.

All tables here are short literals, so joining them by broadcast is bounded by
construction (29 cities, 14 countries, 15 currencies).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# City, country, latitude, longitude. The position is the tie-break order.
CITIES: list[tuple[str, str, float, float]] = [
    ("Tokyo", "JP", 35.6762, 139.6503),
    ("Osaka", "JP", 34.6937, 135.5023),
    ("Nagoya", "JP", 35.1815, 136.9066),
    ("Fukuoka", "JP", 33.5904, 130.4017),
    ("Sapporo", "JP", 43.0618, 141.3545),
    ("Shanghai", "CN", 31.2304, 121.4737),
    ("Beijing", "CN", 39.9042, 116.4074),
    ("Guangzhou", "CN", 23.1291, 113.2644),
    ("Shenzhen", "CN", 22.5431, 114.0579),
    ("Chengdu", "CN", 30.5728, 104.0668),
    ("Wuhan", "CN", 30.5928, 114.3055),
    ("Hangzhou", "CN", 30.2741, 120.1551),
    ("Nanjing", "CN", 32.0603, 118.7969),
    ("Seoul", "KR", 37.5665, 126.9780),
    ("Busan", "KR", 35.1796, 129.0756),
    ("Incheon", "KR", 37.4563, 126.7052),
    ("Singapore", "SG", 1.3521, 103.8198),
    ("Bangkok", "TH", 13.7563, 100.5018),
    ("Jakarta", "ID", -6.2088, 106.8456),
    ("Kuala Lumpur", "MY", 3.1390, 101.6869),
    ("Manila", "PH", 14.5995, 120.9842),
    ("Ho Chi Minh City", "VN", 10.8231, 106.6297),
    ("Hanoi", "VN", 21.0278, 105.8342),
    ("Mumbai", "IN", 19.0760, 72.8777),
    ("Delhi", "IN", 28.6139, 77.2090),
    ("Bangalore", "IN", 12.9716, 77.5946),
    ("Chennai", "IN", 13.0827, 80.2707),
    ("Sydney", "AU", -33.8688, 151.2093),
    ("Melbourne", "AU", -37.8136, 144.9631),
]

# Country, economic region, GDP per capita in USD, urban share, currency.
COUNTRIES: list[tuple[str, str, float, float, str]] = [
    ("JP", "East Asia Developed", 33900.0, 0.92, "JPY"),
    ("KR", "East Asia Developed", 33100.0, 0.81, "KRW"),
    ("SG", "ASEAN Core", 82800.0, 1.00, "SGD"),
    ("CN", "Greater China", 12700.0, 0.64, "CNY"),
    ("HK", "Greater China", 49300.0, 1.00, "HKD"),
    ("TW", "Greater China", 33100.0, 0.79, "TWD"),
    ("TH", "ASEAN Core", 7200.0, 0.52, "THB"),
    ("MY", "ASEAN Core", 12000.0, 0.78, "MYR"),
    ("ID", "ASEAN Core", 4800.0, 0.57, "IDR"),
    ("PH", "ASEAN Core", 3900.0, 0.48, "PHP"),
    ("VN", "ASEAN Frontier", 4300.0, 0.38, "VND"),
    ("IN", "South Asia", 2500.0, 0.36, "INR"),
    ("AU", "Oceania", 65100.0, 0.86, "AUD"),
    ("NZ", "Oceania", 48500.0, 0.87, "NZD"),
]

DEFAULT_REGION = "Other"
DEFAULT_CURRENCY = "USD"

# One unit of the currency in USD when no dated rate exists.
FALLBACK_USD_RATES: list[tuple[str, float]] = [
    ("JPY", 0.0067), ("KRW", 0.00075), ("CNY", 0.14),
    ("HKD", 0.128), ("TWD", 0.032), ("SGD", 0.74),
    ("THB", 0.028), ("MYR", 0.21), ("IDR", 0.000064),
    ("PHP", 0.018), ("VND", 0.000041), ("INR", 0.012),
    ("AUD", 0.66), ("NZD", 0.61), ("USD", 1.0),
]

# Currencies a fund may report in, and those flagged as volatile.
REPORTING_CURRENCIES = ("USD", "SGD", "HKD", "JPY")
HIGH_VOLATILITY_CURRENCIES = ("IDR", "INR", "PHP", "VND", "THB")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"double('{value!r}')"
    return str(value)


def values_frame(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A literal table the optimizer sees as a local relation (no Python worker, known size)."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def lookup(rows: Sequence[tuple], key: Column, field: int = 1) -> Column:
    """The ``field`` of the row whose first entry is ``key``, null if there is none: a projection, no join."""
    pairs = ", ".join(f"{_literal(row[0])}, {_literal(row[field])}" for row in rows)
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def city_array() -> Column:
    """The cities as one literal array of (ord, city, lat, lon)."""
    items = ", ".join(
        f"named_struct('ord', {i}, 'city', {_literal(c[0])}, 'lat', {_literal(c[2])}, 'lon', {_literal(c[3])})"
        for i, c in enumerate(CITIES))
    return F.expr(f"array({items})")


def cities(spark: SparkSession) -> DataFrame:
    rows = [(i, *c) for i, c in enumerate(CITIES)]
    return values_frame(spark, rows, ["ord", "city", "country", "city_lat", "city_lon"])


def countries(spark: SparkSession) -> DataFrame:
    return values_frame(
        spark, COUNTRIES,
        ["country", "economic_region", "gdp_per_capita_usd", "urbanization_rate", "currency"],
    )


def fallback_rates(spark: SparkSession) -> DataFrame:
    return values_frame(spark, FALLBACK_USD_RATES, ["currency", "usd_rate"])
