import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surtido.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


RAW = ("InvoiceNo string, StockCode string, Description string, Quantity int, "
       "InvoiceDate timestamp, UnitPrice double, CustomerID double, Country string")


@pytest.fixture(scope="session")
def raw_lines(spark):
    """Raw invoice lines from short tuples; fields not given take plain values."""
    def build(*rows):
        defaults = dict(InvoiceNo="1", StockCode="a", Description="thing", Quantity=1,
                        InvoiceDate=dt.datetime(2011, 3, 1, 8), UnitPrice=1.0, CustomerID=7.0,
                        Country="UK")
        return spark.createDataFrame(
            [tuple((defaults | row).values()) for row in rows], RAW)
    return build


@pytest.fixture(scope="session")
def clean_sales(spark):
    """Clean lines from (product, date, units) or (product, date, units, name, price)."""
    def build(*rows):
        full = [("1", r[0], r[3] if len(r) > 3 else "N", r[2], dt.date.fromisoformat(r[1]),
                 float(r[4]) if len(r) > 4 else 1.0, 0,
                 float(r[2] * (r[4] if len(r) > 4 else 1))) for r in rows]
        return spark.createDataFrame(
            full, "id_venta_original string, id_producto string, nombre string, "
                  "unidades_vendidas int, fecha_venta date, precio_unitario double, "
                  "CustomerID bigint, total_venta double")
    return build


@pytest.fixture(scope="session")
def monthly(spark):
    """A monthly series from values, starting at a given month; None leaves a gap."""
    def build(values, key="s", start=(2010, 1)):
        rows = []
        for i, value in enumerate(values):
            month = start[1] - 1 + i
            if value is not None:
                rows.append((key, dt.date(start[0] + month // 12, month % 12 + 1, 1), float(value)))
        return spark.createDataFrame(rows, "series_key string, fecha date, ventas double")
    return build
