import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from surtido.operators import features as f
from surtido.operators import series as o
from surtido.operators.ridge import cv_folds, error_metrics


def values(df, *names, order="fecha"):
    return [tuple(r[n] for n in names) for r in df.orderBy(order).collect()]


def test_months_without_sales_are_filled_with_zero(clean_sales):
    sales = clean_sales(("a", "2011-01-05", 2), ("a", "2011-01-05", 3), ("b", "2011-01-09", 1),
                        ("a", "2011-04-30", 7))
    filled = o.fill_months(o.monthly_units(sales))
    assert values(filled, "ventas", "dias") == [(6, 2), (0, 0), (0, 0), (7, 1)]
    assert filled.select("fecha").distinct().count() == 4


def test_a_month_needs_25_sale_days(clean_sales):
    sales = clean_sales(*[("a", f"2011-01-{d:02d}", 1) for d in range(1, 26)],
                        *[("a", f"2011-02-{d:02d}", 1) for d in range(1, 25)])
    assert values(o.demand_series(sales), "fecha", "ventas") == [(dt.date(2011, 1, 1), 25.0)]


def test_series_per_key(clean_sales):
    sales = clean_sales(("a", "2011-01-05", 2), ("b", "2011-01-05", 3))
    daily = o.daily_units(sales, ["id_producto"])
    assert values(daily, "series_key", "ventas", order="series_key") == [("a", 2), ("b", 3)]


def test_fences_and_capping(monthly):
    series = monthly([1, 2, 3, 4, 100])
    fences = o.iqr_fences(series).first()
    assert (fences.q1, fences.q3, fences.limite_bajo, fences.limite_alto) == (2.0, 4.0, -4.0, 10.0)
    assert fences.detectados == 1
    assert values(o.cap_outliers(series), "ventas") == [(1.0,), (2.0,), (3.0,), (4.0,), (10.0,)]


def test_skewness_is_bias_adjusted(monthly):
    series = monthly([i * i for i in range(7)])
    assert o.skew_report(series).first().asimetria == pytest.approx(
        pd.Series([i * i for i in range(7)]).skew())
    assert o.skew_report(monthly([1, 2])).first().asimetria is None


def pandas_features(values):
    s = pd.Series(values, dtype=float)
    past = s.shift(1)
    return pd.DataFrame({
        "lag_1": past, "lag_2": s.shift(2), "lag_3": s.shift(3), "media_3": past.rolling(3).mean(),
        "std_3": past.rolling(3).std(), "diff_1": past - s.shift(2), "tendencia": range(len(s)),
    })


def test_features_bridge_gaps_and_drop_rows_without_history(monthly):
    series = monthly([5, 7, None, 4, 9, None, None, 2, 8])
    rows = f.feature_matrix(series).orderBy("fecha").toPandas()
    want = pandas_features([5, 7, 4, 9, 2, 8]).dropna()
    assert len(rows) == 3 and list(rows["tendencia"]) == [3, 4, 5]
    for name in want.columns:
        np.testing.assert_allclose(rows[name].astype(float), want[name].astype(float))
    assert list(rows["mes"]) == [5, 8, 9] and list(rows["trimestre"]) == [2, 3, 3]
    assert rows["mes_sin"][0] == pytest.approx(math.sin(2 * math.pi * 5 / 12))


def test_rolling_needs_three_full_rows(monthly):
    rows = monthly([1, 2, 3, 4]).withColumns(f.rolling_columns())
    assert values(rows, "media_3", "std_3") == [(None, None)] * 3 + [(2.0, 1.0)]


@pytest.mark.parametrize("n, n_test", [(1, 1), (2, 1), (7, 1), (8, 2), (12, 2), (13, 3)])
def test_newest_fifth_is_tested(monthly, n, n_test):
    split = f.time_split(monthly(range(1, n + 1)))
    assert [p for (p,) in values(split, "parte")] == ["train"] * (n - n_test) + ["test"] * n_test


def test_scaling_leaves_constant_columns_alone(monthly):
    rows = monthly([0.1] * 7).withColumn("x1", o.F.col("ventas") * 3)
    scaled = f.scaled_features(rows, ["ventas", "x1"]).collect()
    assert all(r.escala == [1.0, 1.0] for r in scaled)
    assert all(abs(v) < 1e-12 for r in scaled for v in r.x)


@pytest.mark.parametrize("n", [6, 9, 10, 13, 21])
def test_folds_are_the_tail_blocks(monthly, n):
    size = n // 5
    starts = range(n - 4 * size, n, size)
    got = [(r.pliegue, r.n_train, r.n_test)
           for r in cv_folds(monthly(range(n))).orderBy("pliegue").collect()]
    assert got == [(k, s, size) for k, s in enumerate(starts)]


def test_no_folds_below_six_rows(monthly):
    assert cv_folds(monthly(range(5))).count() == 0


def test_metrics_at_the_edges(spark):
    schema = "series_key string, ventas_reales double, ventas_predichas double"
    pairs = spark.createDataFrame(
        [("one", 5.0, 4.0), ("flat", 3.0, 3.0), ("flat", 3.0, 3.0), ("off", 3.0, 3.0),
         ("off", 3.0, 4.0), ("ok", 1.0, 1.0), ("ok", 3.0, 2.0)], schema)
    rows = {r.series_key: r for r in error_metrics(pairs).collect()}
    assert rows["one"].r2 is None and rows["one"].rmse == 1.0
    assert rows["flat"].r2 == 1.0 and rows["off"].r2 == 0.0
    assert rows["ok"].r2 == pytest.approx(0.5) and rows["ok"].mae == 0.5
