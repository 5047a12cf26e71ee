import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from surtido.operators import serving as v
from surtido.operators.allocation import allocate, global_rows, product_shares, to_forecast_rows
from surtido.operators.catalog import sales_fact

PREDICTIONS = ("id_producto string, fecha_prediccion date, unidades_predichas int, "
               "unidades_vendidas int, confianza_modelo decimal(5,4)")
PRODUCTS = "id_producto string, nombre string, categoria string, precio_unitario decimal(10,2)"
JAN, FEB = dt.date(2012, 1, 1), dt.date(2012, 2, 1)


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(
        [("a", FEB, None, 3, None), ("a", JAN, 5, 5, Decimal("0.5000")),
         ("x", JAN, 1, 1, Decimal("0.5000")), (None, JAN, 9, None, None)], PREDICTIONS)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [("a", "N" * 50, "c", Decimal("2.35")), ("b", "B", "c", Decimal("1.00"))], PRODUCTS)


def test_key_figures_and_zeros(spark, clean_sales, products):
    sales = sales_fact(clean_sales(("a", "2011-01-01", 2, "N", 1.5), ("b", "2011-01-02", 3)))
    row = v.kpis(sales, products).first()
    assert row == (Decimal("6.00"), 5, 2)
    assert v.kpis(sales.limit(0), products.limit(0)).first() == (Decimal("0.00"), 0, 0)


def test_product_list_is_ordered_and_limited(spark):
    rows = [(f"p{i:04d}", f"name {i % 7}", "c", Decimal(1)) for i in range(600)]
    got = v.product_list(spark.createDataFrame(rows, PRODUCTS), limit=500).collect()
    want = sorted(((r[1], r[0]) for r in rows))[:500]
    assert [(r.nombre, r.id_producto) for r in got] == want


def test_label_cuts_the_name(products):
    labels = {r.id_producto: r.etiqueta for r in v.product_labels(products).collect()}
    assert labels == {"a": "a — " + "N" * 40, "b": "b — B"}


def test_recent_sales_count_thirty_days_from_each_products_own_last_day(clean_sales):
    sales = sales_fact(clean_sales(
        ("a", "2011-03-31", 1), ("a", "2011-03-31", 2), ("a", "2011-03-01", 4),
        ("a", "2011-02-28", 8), ("b", "2010-01-01", 5)))
    got = {(r.id_producto, str(r.fecha_venta)): r.unidades for r in v.recent_sales(sales).collect()}
    assert got == {("a", "2011-03-31"): 3, ("a", "2011-03-01"): 4, ("b", "2010-01-01"): 5}
    one = v.recent_sales(sales, "a").orderBy("fecha_venta").collect()
    assert one == v.recent_sales_sql(sales, "a").orderBy("fecha_venta").collect()
    lists = v.recent_sales_lists(sales, "a").first()
    assert (lists.fechas, lists.unidades) == (["2011-03-01", "2011-03-31"], [4, 3])
    assert v.recent_sales_lists(sales, "none").count() == 0


def test_a_product_code_is_data_not_sql(clean_sales):
    sales = sales_fact(clean_sales(("a", "2011-03-31", 1)))
    assert v.recent_sales_sql(sales, "' or 1=1 --").count() == 0


def test_last_twelve_months_of_each_product(clean_sales):
    sales = sales_fact(clean_sales(("a", "2011-03-31", 1), ("a", "2010-04-01", 2),
                                   ("a", "2010-03-31", 4), ("b", "2001-01-01", 5)))
    got = {(r.id_producto, str(r.mes)): r.unidades
           for r in v.monthly_sales_last_year(sales).collect()}
    assert got == {("a", "2011-03-01"): 1, ("a", "2010-04-01"): 2, ("b", "2001-01-01"): 5}


def test_confidence_counts_missing_values_as_zero(predictions):
    row = v.forecast_lists(predictions, "a").first()
    assert row.fechas == ["2012-01-01", "2012-02-01"]
    assert row.predichas == [5, 0] and row.confianza == 0.25
    assert v.forecast_lists(predictions, "none").count() == 0
    assert {r.id_producto for r in v.mean_confidence(predictions).collect()} == {"a", "x"}


def test_global_series_has_no_product(predictions):
    row = v.global_forecast_lists(predictions).first()
    assert (row.fechas, row.reales, row.predichas) == (["2012-01-01"], [0], [9])


def test_investment_needs_a_known_product(predictions, products):
    rows = v.investment(predictions, products).orderBy("fecha_prediccion").collect()
    assert [(r.id_producto, r.inversion) for r in rows] == [("a", Decimal("11.75")), ("a", Decimal("0.00"))]
    assert v.investment(predictions, products, "x").count() == 0
    lists = v.investment_lists(predictions, products).first()
    assert lists.inversion == [Decimal("11.75"), Decimal("0.00")]


def test_gauge(spark):
    df = spark.createDataFrame([(0.876,), (None,)], "confianza double")
    rows = {r.confianza: (r.porcentaje, r.margen, r.texto) for r in v.confidence_gauge(df).collect()}
    assert rows[None] == (0.0, 100.0, "Sin datos")
    assert rows[0.876] == (pytest.approx(87.6), pytest.approx(12.4), "87.6%")


def test_shares_sum_to_one_and_forecast_is_spread(spark, clean_sales):
    sales = sales_fact(clean_sales(("a", "2011-01-01", 1), ("a", "2011-01-02", 2),
                                   ("b", "2011-01-02", 5), ("c", "2011-01-02", 2)))
    shares = product_shares(sales)
    assert shares.agg(F.sum("cuota")).first()[0] == pytest.approx(1.0)
    forecast = spark.createDataFrame([(JAN, 25.0, 25.0), (FEB, 10.0, 10.0)],
                                     "fecha date, ventas_predichas double, ventas_reales double")
    got = {(r.id_producto, r.fecha_prediccion): r.unidades_predichas
           for r in to_forecast_rows(allocate(forecast, shares, F.lit(0.5))).collect()}
    assert got == {("a", JAN): 8, ("a", FEB): 3, ("b", JAN): 12, ("b", FEB): 5,
                   ("c", JAN): 5, ("c", FEB): 2}
    row = to_forecast_rows(global_rows(forecast, F.lit(None))).orderBy("fecha_prediccion").first()
    assert (row.id_producto, row.unidades_predichas, row.confianza_modelo) == (None, 25, None)
    assert allocate(forecast.limit(0), shares, F.lit(0.5)).count() == 0
