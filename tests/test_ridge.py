import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from surtido.constants import ALPHA_GRID, FEATURES
from surtido.operators.features import prepared_series
from surtido.operators.forecast import forecast_next_year, recursive_steps
from surtido.operators.ridge import backtest_metrics, backtest_rows, confidence, fit_models


def closed_form(x, y, alpha):
    mean = x.mean(axis=0)
    c = x - mean
    w = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ (y - y.mean()))
    return w, y.mean() - w @ mean


def scaled(rows):
    x, y = rows[list(FEATURES)].to_numpy(float), rows["ventas"].to_numpy(float)
    scale = x.std(axis=0)
    scale[scale < 1e-12] = 1.0
    return (x - x.mean(axis=0)) / scale, y, x.mean(axis=0), scale


def fold_scores(z, y):
    """Mean RMSE over the folds per alpha, from the residuals of the rows."""
    n, scores = len(y), []
    size = n // 5
    for a in ALPHA_GRID:
        errors = []
        for start in range(n - 4 * size, n, size):
            w, b = closed_form(z[:start], y[:start], a)
            miss = y[start:start + size] - z[start:start + size] @ w - b
            errors.append(math.sqrt((miss ** 2).mean()))
        scores.append(np.mean(errors))
    return scores


def direct_fit(rows):
    """Scaler, alpha by folds cut from the rows themselves, and the final coefficients."""
    z, y, mean, scale = scaled(rows)
    alpha = ALPHA_GRID[int(np.argmin(fold_scores(z, y)))] if len(y) >= 6 else 10.0
    return alpha, *closed_form(z, y, alpha), mean, scale


@pytest.fixture(scope="module")
def many(spark, monthly):
    """Twelve series of different lengths and shapes."""
    rng = np.random.default_rng(3)
    series = None
    for i in range(12):
        n = 8 + 4 * i
        t = np.arange(n)
        level = 1000 + 20 * i * t + 200 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 40 + 30 * i, n)
        part = monthly(np.maximum(level.round(), 1), key=f"s{i:02d}")
        series = part if series is None else series.unionByName(part)
    return prepared_series(series)


def test_models_equal_a_direct_search_on_the_rows(many):
    models = {r.series_key: r for r in fit_models(many).collect()}
    rows = many.orderBy("series_key", "fecha").toPandas()
    assert len(models) == 12
    for key, own in rows.groupby("series_key"):
        alpha, w, b, mean, scale = direct_fit(own)
        got = models[key]
        assert (got.n, got.alpha) == (len(own), alpha)
        np.testing.assert_allclose(got.coef, w, atol=1e-9)
        np.testing.assert_allclose(got.media, mean, atol=1e-9)
        np.testing.assert_allclose(got.escala, scale, atol=1e-9)
        assert got.intercepto == pytest.approx(b, abs=1e-9)


def test_near_ties_are_chosen_as_by_row_errors(monthly):
    """Series that a line fits nearly exactly: the chosen alpha is as good as the best one."""
    for k, growth in enumerate((1.0001, 1.01, 1.3)):
        values = [round(1e6 * growth ** t, 3) for t in range(40)]
        prepared = prepared_series(monthly(values, key=f"tie{k}"))
        scores = fold_scores(*scaled(prepared.orderBy("fecha").toPandas())[:2])
        model = fit_models(prepared).first()
        assert scores[ALPHA_GRID.index(model.alpha)] <= min(scores) * (1 + 1e-6) + 1e-9


def test_the_rule_for_short_series_is_an_option(many):
    usual = {r.series_key: r for r in fit_models(many).collect()}
    changed = {r.series_key: r for r in fit_models(many, min_rows=10, fallback=3.0).collect()}
    assert [k for k, r in usual.items() if not r.buscada] == [
        k for k, r in usual.items() if r.n < 6]
    assert all((r.n < 10) != r.buscada for r in changed.values())
    assert all(r.alpha == 3.0 for r in changed.values() if not r.buscada)
    with pytest.raises(ValueError):
        fit_models(many, min_rows=4)


@pytest.mark.parametrize("months, n", [(4, 1), (8, 5), (9, 6)])
def test_short_series_take_the_fallback(monthly, months, n):
    rng = np.random.default_rng(months)
    model = fit_models(prepared_series(monthly(rng.integers(50, 99, months)))).first()
    assert model.n == n
    assert (model.cv_rmse is None) == (n < 6)
    if n < 6:
        assert model.alpha == 10.0


def test_series_without_history_have_no_model(monthly):
    assert fit_models(prepared_series(monthly([1, 2, 3]))).count() == 0


def test_constant_series_forecast_themselves(monthly):
    models = fit_models(prepared_series(monthly([40] * 20)))
    assert models.first().alpha == ALPHA_GRID[0]
    rows = forecast_next_year(models).collect()
    assert len(rows) == 12
    assert all(r.ventas_predichas == pytest.approx(40.0) for r in rows)


def stepwise(model):
    """The recursion written as a loop."""
    past = [model.h3, model.h2, model.h1]
    trend, month, out = model.tendencia_fin, model.ultima, {}
    while (month.year, month.month) < (model.ultima.year + 1, 12):
        month = dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)
        trend += 1
        last = past[-3:]
        x = [last[2], last[1], last[0], np.mean(last), np.std(last, ddof=1), last[2] - last[1],
             month.month, (month.month - 1) // 3 + 1, trend,
             math.sin(2 * math.pi * month.month / 12), math.cos(2 * math.pi * month.month / 12)]
        z = (np.array(x) - model.media) / model.escala
        past.append(max(0.0, model.intercepto + float(z @ np.array(model.coef))))
        out[month] = past[-1]
    return out


def test_recursion_equals_a_loop(many):
    models = fit_models(many)
    got = {}
    for r in recursive_steps(models).collect():
        got.setdefault(r.series_key, {})[r.fecha] = r.prediccion
    for model in models.collect():
        want = stepwise(model)
        assert got[model.series_key].keys() == want.keys()
        for month, value in want.items():
            assert got[model.series_key][month] == pytest.approx(value, abs=1e-9)


def test_every_series_gets_the_twelve_months_of_the_next_year(many):
    forecast = forecast_next_year(fit_models(many))
    counts = forecast.groupBy("series_key").agg(
        F.count("*").alias("n"), F.countDistinct(F.month("fecha")).alias("m"),
        F.countDistinct(F.year("fecha")).alias("y"))
    assert {(r.n, r.m, r.y) for r in counts.collect()} == {(12, 12, 1)}


def test_predictions_do_not_fall_below_zero(monthly):
    falling = prepared_series(monthly([10 ** (6 - i / 3) for i in range(18)]))
    models = fit_models(falling).withColumn("intercepto", F.lit(-50.0))
    assert {r.ventas_predichas for r in forecast_next_year(models).collect()} == {0.0}


def test_backtest_does_not_see_the_test_rows(many):
    rows = many.orderBy("series_key", "fecha").toPandas()
    pairs = backtest_rows(many).toPandas()
    for key, own in rows.groupby("series_key"):
        n_test = max(1, round(len(own) * 0.2))
        train, test = own.iloc[:-n_test], own.iloc[-n_test:]
        got = pairs[pairs.series_key == key].sort_values("fecha")
        assert list(got.fecha) == list(test.fecha)
        alpha, w, b, mean, scale = direct_fit(train)
        z = (test[list(FEATURES)].to_numpy(float) - mean) / scale
        np.testing.assert_allclose(
            got.ventas_predichas, np.expm1(np.maximum(0, z @ w + b)), rtol=1e-6)


def test_confidence_is_bounded(many):
    metrics = backtest_metrics(many)
    for r in confidence(metrics).collect():
        assert r.confianza is None or 0.0 <= r.confianza <= 1.0
    assert metrics.filter("sospechoso and r2 <= 0.99").count() == 0
