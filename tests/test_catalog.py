"""Every checked query against its SQL, on the smallest tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

from storelens import catalog
from storelens.catalog import check

SF = os.environ.get("STORELENS_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) <= {"kpi_tooltips"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in SQL:
        assert QUERIES[name](spark, SF).count() > 0
        return
    problem, _ = check.compare(spark, con, SF, QUERIES[name], SQL[name])
    assert not problem


NESTED_LOOPS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", [
    "kpi_table", "region_full_summary", "same_store_yoy", "fx_dated_amounts", "currency_exposure", "clean_key_copies",
    "clean_fill_dates", "contract_accepted_sheets", "report_headline", "geo_stores_near_point", "state_file_statistics"])
def test_no_nested_loop_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in NESTED_LOOPS if n in plan]


def test_totals_are_aggregated_before_the_shuffle(spark):
    plan = QUERIES["report_revenue_by_region"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortMergeJoin" not in plan


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["concentration_index"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "l_shipdate" not in schema and "l_partkey" not in schema and "l_suppkey" in schema


def test_store_radius_reaches_the_scan(spark, tmp_path):
    from storelens.operators import geo
    rows = spark.createDataFrame([("a", "JP", "R", 35.0, 139.0), ("b", "JP", "R", 10.0, 139.0)],
                                 "store_id string, country string, economic_region string, latitude double, longitude double")
    rows.write.parquet(str(tmp_path / "stores"))
    near = geo.stores_near(spark.read.parquet(str(tmp_path / "stores")), 35.0, 139.0, 50.0)
    assert [r.store_id for r in near.collect()] == ["a"]
    assert "GreaterThanOrEqual(latitude" in near._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["contract_accepted_rows", "contract_accepted_sheets"])
def test_contract_checks_are_compiled_in_any_session(spark, name):
    # the JVM interprets methods above 8000 bytes; Spark's default lets them pass
    plain = {"spark.sql.codegen.hugeMethodLimit": "65535", "spark.sql.adaptive.enabled": "false"}
    tuned = {key: spark.conf.get(key) for key in plain}
    try:
        for key, value in plain.items():
            spark.conf.set(key, value)
        code = spark._jvm.PythonSQLUtils.explainString(QUERIES[name](spark, SF)._jdf.queryExecution(), "codegen")
    finally:
        for key, value in tuned.items():
            spark.conf.set(key, value)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000


def test_file_names_are_taken_from_the_sales_once(spark, monkeypatch):
    from storelens.catalog import frames, state
    evaluated, sales = spark.sparkContext.accumulator(0), frames.usd_sales(spark, SF, "country")

    @F.udf("string")
    def seen(country):
        evaluated.add(1)
        return country

    monkeypatch.setattr(frames, "usd_sales", lambda *_: sales.withColumn("country", seen("country")))
    assert state.incremental_kpis(spark, SF).count() > 0
    # once for the names, once for each of three loads
    assert evaluated.value <= 4 * sales.count()


def test_workbooks_are_decoded_once(spark):
    found = catalog.queries()["ingest_workbook_round_trip"](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "SortMergeJoin" not in plan  # the typed rows are read, rejected sheets are sent to them
