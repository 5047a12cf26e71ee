import datetime as dt

from surtido.operators import cleaning as c
from surtido.operators.audit import cleaning_audit, split_audit
from surtido.operators.catalog import (
    active_days, keep_valid, last_month_lines, split_tables, top_price_catalog, valid_products,
)


def column(df, name):
    return sorted(r[name] for r in df.collect())


def test_missing_and_nonpositive_numbers_go(raw_lines):
    lines = raw_lines({"InvoiceNo": "1", "UnitPrice": float("nan")}, {"InvoiceNo": "2", "UnitPrice": None},
                      {"InvoiceNo": "3", "Quantity": None}, {"InvoiceNo": "4", "Quantity": 0},
                      {"InvoiceNo": "5", "UnitPrice": -1.0}, {"InvoiceNo": "6"})
    assert column(c.keep_positive(lines), "InvoiceNo") == ["6"]


def test_only_capital_c_cancels_and_missing_number_stays(raw_lines):
    lines = raw_lines({"InvoiceNo": "C1"}, {"InvoiceNo": "c123"}, {"InvoiceNo": None}, {"InvoiceNo": "9"})
    kept = [r.InvoiceNo for r in c.drop_cancelled(lines).collect()]
    assert sorted(map(str, kept)) == ["9", "None", "c123"]


def test_duplicates_are_judged_before_normalisation(raw_lines):
    lines = raw_lines({}, {}, {"InvoiceDate": dt.datetime(2011, 3, 1, 9)}, {"StockCode": "A"},
                      {"Description": None}, {"Description": None})
    clean = c.clean_lines(lines)
    assert clean.count() == 4
    assert column(clean.filter("nombre = 'SIN DESCRIPCIÓN'"), "id_producto") == ["A"]


def test_total_is_rounded_half_to_even(raw_lines):
    lines = raw_lines({"UnitPrice": 0.125}, {"UnitPrice": 1.005}, {"UnitPrice": 2.675})
    assert column(c.add_line_total(lines), "total_venta") == [0.12, 1.0, 2.68]


def test_text_is_stripped_of_all_white_space(raw_lines):
    lines = raw_lines({"Description": "\t  ñandú  \n", "StockCode": " \t a "},
                      {"Description": "  ", "StockCode": "b\x1f"})
    rows = {r.StockCode: r.Description for r in c.normalize_text(lines).collect()}
    assert rows == {"A": "ÑANDÚ", "B": ""}


def test_customer_is_optional_and_filled(raw_lines):
    lines = raw_lines({"CustomerID": None})
    assert c.fill_missing(lines).first().CustomerID == 0
    assert c.clean_lines(lines.drop("CustomerID")).first().CustomerID == 0


def test_lines_without_a_code_are_kept_under_one(raw_lines):
    lines = raw_lines({"StockCode": None}, {"StockCode": None, "Quantity": 2})
    assert column(c.clean_lines(lines), "id_producto") == ["NAN", "NAN"]


def test_extra_columns_ride_along(raw_lines):
    clean = c.clean_lines(raw_lines({}))
    assert clean.first().Country == "UK"
    assert clean.first().fecha_venta == dt.date(2011, 3, 1)


def test_normalising_twice_changes_nothing(raw_lines):
    once = c.normalize_text(raw_lines({"Description": " a\tb "}))
    assert c.normalize_text(once).collect() == once.collect()


def test_audit_counts_every_step(raw_lines):
    lines = raw_lines({"InvoiceNo": "C1"}, {"Quantity": -1}, {"UnitPrice": float("nan")}, {}, {},
                      {"InvoiceNo": None, "Quantity": None})
    rows = [(r.paso, r.filas) for r in cleaning_audit(lines).orderBy("orden").collect()]
    assert rows == [("inicio", 6), ("sin_cancelaciones", 5), ("cantidad_positiva", 3),
                    ("precio_positivo", 2), ("sin_duplicados", 1)]
    assert [n for _, n in rows] == sorted((n for _, n in rows), reverse=True)
    counted = c.normalize_lines(c.count_copies(lines))  # as a reload writes them
    assert cleaning_audit(counted).collect() == cleaning_audit(lines).collect()


def test_last_month_is_a_calendar_month_clipped_at_its_end(clean_sales):
    sales = clean_sales(("a", "2011-03-31", 1), ("a", "2011-02-28", 1), ("a", "2011-02-27", 1))
    assert column(last_month_lines(sales), "fecha_venta") == [dt.date(2011, 2, 28), dt.date(2011, 3, 31)]


def test_products_need_enough_distinct_days(clean_sales):
    days = [f"2011-03-{d:02d}" for d in range(1, 6)]
    sales = clean_sales(*[("a", d, 1) for d in days], *[("b", d, 1) for d in days[:4]],
                        *[("b", days[0], 9)] * 9, ("a", "2001-01-01", 4), ("c", "2001-01-01", 1))
    assert {r.id_producto: r.dias_vendido for r in active_days(sales).collect()} == {"a": 5, "b": 4}
    assert column(valid_products(sales), "id_producto") == ["a"]
    assert keep_valid(sales).count() == 6
    audit = {r.medida: r.filas for r in split_audit(sales).collect()}
    assert audit == {"productos_excluidos": 1, "productos_unicos": 1, "filas_antes": 20,
                     "filas_restantes": 6}


def test_catalogue_keeps_the_top_price_and_breaks_ties_by_name(clean_sales):
    sales = clean_sales(("a", "2011-01-01", 1, "Z", 5), ("a", "2011-01-02", 1, "M", 9),
                        ("a", "2011-01-03", 1, "B", 9), ("b", "2011-01-03", 1, "Q", 1))
    rows = {r.id_producto: (r.nombre, r.precio_unitario, r.categoria)
            for r in top_price_catalog(sales).collect()}
    assert rows == {"a": ("B", 9.0, "Sin categoría"), "b": ("Q", 1.0, "Sin categoría")}


def test_split_of_nothing_is_empty(clean_sales):
    productos, ventas = split_tables(clean_sales(("a", "2011-01-01", 1)))
    assert productos.count() == 0 and ventas.count() == 0
    assert ventas.columns == ["id_venta_original", "id_producto", "fecha_venta",
                              "unidades_vendidas", "total_venta"]
