"""Shapes of the plans that keep the operators fast on large data."""

import re

import pytest

from surtido.operators import cleaning, serving
from surtido.operators.allocation import allocate, product_shares
from surtido.operators.catalog import top_price_catalog, valid_products
from surtido.operators.features import prepared_series
from surtido.operators.forecast import forecast_next_year
from surtido.operators.ridge import fit_models
from surtido.operators.series import demand_series
from surtido.sinks import clear_tables
from surtido.sources import read_stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single)", plan(df)))


@pytest.fixture(scope="module")
def clean(raw_lines):
    return cleaning.clean_lines(raw_lines({}))


def test_cleaning_shuffles_once_and_stays_in_the_jvm(clean):
    text = plan(clean)
    assert exchanges(clean) == 1
    assert "Python" not in text and "Pandas" not in text


def test_duplicates_are_dropped_before_the_shuffle(clean):
    text = plan(clean)
    assert text.count("HashAggregate(keys=[") == 2


def test_nothing_is_joined_without_a_key(clean, spark):
    forecast = forecast_next_year(fit_models(prepared_series(demand_series(clean))))
    rows = allocate(forecast, product_shares(clean), serving.F.lit(1.0))
    for df in (rows, valid_products(clean), serving.recent_sales(clean)):
        text = plan(df)
        assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_a_series_moves_once_from_its_months_to_its_model(clean):
    models = fit_models(prepared_series(demand_series(clean, ["Country"])))
    # duplicate removal, days, months, series
    assert exchanges(models) == 4
    assert len(re.findall(r"hashpartitioning\(series_key#\d+, \d+\)", plan(models))) == 1


def test_recursion_needs_no_shuffle(clean):
    models = fit_models(prepared_series(demand_series(clean)))
    assert exchanges(forecast_next_year(models)) == exchanges(models)


def test_top_price_ranks_aggregated_rows(clean):
    text = plan(top_price_catalog(clean))
    assert "WindowGroupLimit" in text
    assert text.index("WindowGroupLimit") < text.index("max(precio_unitario")


def test_one_product_is_pushed_to_the_scan(spark, tmp_path):
    clear_tables(spark, str(tmp_path))
    text = plan(serving.recent_sales(read_stored(spark, str(tmp_path), "ventas"), "a"))
    assert "EqualTo(id_producto,a)" in text
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert columns == "id_producto:string,fecha_venta:date,unidades_vendidas:int"


def test_row_groups_without_the_product_are_not_read(spark, clean_sales, tmp_path, plain_plans):
    from surtido.sinks import append_sales
    folder = str(tmp_path)
    clear_tables(spark, folder)
    append_sales(clean_sales(*[(p, f"2010-03-{d:02d}", 1) for p in ("A", "C", "E")
                               for d in range(1, 28)]).coalesce(1), folder)

    def rows_read(product):
        found = read_stored(spark, folder, "ventas").where(f"id_producto = '{product}'")
        physical = found._jdf.queryExecution().executedPlan()
        n = physical.executeCollect().__len__()
        while physical.children().size():
            physical = physical.children().head()
        return n, physical.metrics().apply("numOutputRows").value()

    assert rows_read("C")[0] == 27
    assert rows_read("D") == (0, 0)  # within the files' ranges of products


def test_recent_sales_read_recent_months_only(spark, clean_sales, tmp_path):
    from surtido.sinks import append_sales
    from surtido.sources import read_recent_sales
    folder = str(tmp_path)
    clear_tables(spark, folder)
    append_sales(clean_sales(*[(p, f"2010-{m:02d}-1{k}", 1) for p in "ab"
                               for m in range(1, 13) for k in range(3)]), folder)
    recent = read_recent_sales(spark, folder, days=30)
    assert "PartitionFilters: [isnotnull(mes" in plan(recent)
    months = {r.m for r in recent.selectExpr("month(fecha_venta) as m").collect()}
    assert months == {11, 12}
    got = sorted(map(tuple, serving.recent_sales(recent).collect()))
    assert got == sorted(map(tuple, serving.recent_sales(
        read_stored(spark, folder, "ventas")).collect()))


def test_product_list_is_a_top_k(spark, tmp_path):
    clear_tables(spark, str(tmp_path))
    productos = read_stored(spark, str(tmp_path), "productos")
    assert "TakeOrderedAndProject(limit=500" in plan(serving.product_list(productos, 500))


def test_every_product_is_listed(spark):
    rows = spark.range(1200).selectExpr("cast(id as string) as id_producto", "'N' as nombre")
    assert serving.product_list(rows).count() == serving.product_labels(rows).count() == 1200


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def scans(df, column):
    """Scans that read a column, in the plan and its subqueries."""
    return len(re.findall(rf"FileScan parquet [^\n]*\b{column}\b[^\n]*ReadSchema", plan(df)))


def test_valid_products_scan_their_lines_once(spark, plain_plans):
    from surtido.registry.base import sold
    assert "ReusedExchange" in plan(valid_products(sold(spark, "/root/testdata/sf0.001")))


@pytest.mark.parametrize("name, count", [
    ("kpis", 0), ("investment", 0), ("sales_fact", 1), ("sales_last_30d_all", 1),
    ("catalog_top_price", 1), ("rows_of_known_products", 2)])
def test_raw_lines_are_scanned_little(spark, plain_plans, name, count):
    """What is left in the plan beside the written lines, or the written valid products."""
    from surtido.registry import QUERIES
    assert scans(QUERIES[name](spark, "/root/testdata/sf0.001"), "l_orderkey") == count


def test_audits_scan_once(spark, plain_plans):
    from surtido.registry import QUERIES
    assert scans(QUERIES["clean_audit"](spark, "/root/testdata/sf0.001"), "l_orderkey") == 1


def test_constraints_of_facts_take_one_scan(spark, tmp_path, plain_plans):
    from surtido.operators.constraints import validate_constraints
    from surtido.sources import read_stored
    clear_tables(spark, str(tmp_path))
    checked = validate_constraints(*[read_stored(spark, str(tmp_path), t)
                                     for t in ("productos", "ventas", "predicciones")])
    assert scans(checked, "fecha_venta") == scans(checked, "fecha_prediccion") == 1
    assert "id_venta primary key" in {r.restriccion for r in checked.collect()}


@pytest.mark.parametrize("name", ["backtest_rows", "backtest_metrics", "forecast_next_year",
                                  "alpha_selected", "ridge_coefficients"])
def test_no_model_query_joins_without_a_key(spark, name):
    from surtido.registry.model import QUERIES
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
