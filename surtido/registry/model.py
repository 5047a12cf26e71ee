"""Ridge models and forecasts. The SQL twins solve the same equations by elimination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.constants import ALPHA_GRID, FALLBACK_ALPHA, FEATURES, TARGET
from surtido.operators import forecast as fc
from surtido.operators import ridge as m
from surtido.operators.features import prepared_series, scaling
from surtido.operators.series import KEY, demand_series, whole_series
from surtido.plans.training import train
from surtido.registry.base import LINES, STORED, clean, monthly_ctes, r_sql, rounded, sql
from surtido.registry.series import (
    COUNTRY_PREPARED, PREPARED, PREPARED_STEPS, country_prepared, prepared,
)

WIDTH = len(FEATURES)


def _alphas(models: DataFrame) -> DataFrame:
    return rounded(models.select(KEY, "n", "alpha", "cv_rmse"), "cv_rmse")


def _coefficients(models: DataFrame) -> DataFrame:
    """One row per feature: coefficient and scaler, and the intercept on every row."""
    parts = F.arrays_zip("coef", "media", "escala")
    rows = models.select(KEY, "intercepto", F.posexplode(parts).alias("i", "p"))
    return rounded(rows.select(KEY, "intercepto", "i", "p.*"),
                   "intercepto", "coef", "media", "escala")


def _gram(rows: DataFrame) -> DataFrame:
    """Products of the scaled features, summed per block."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col("sumas")[p].alias("suma"))
        for p, (i, j) in enumerate(m.PAIRS)
    ])
    sums = m.moments(rows).select(KEY, "bloque", F.explode(pairs).alias("p"))
    return rounded(sums.select(KEY, "bloque", "p.*"), "suma")


def _metrics(rows: DataFrame) -> DataFrame:
    return rounded(m.backtest_metrics(rows), "rmse", "mae", "r2", digits=4)


def _pairs(rows: DataFrame) -> DataFrame:
    return rounded(m.backtest_rows(rows), "ventas_reales", "ventas_predichas", digits=4)


def _forecast(models: DataFrame) -> DataFrame:
    return rounded(fc.forecast_next_year(models), "ventas_reales", "ventas_predichas", digits=4)


def _fixed_models(rows: DataFrame) -> DataFrame:
    """Models with given coefficients, on the scalers and last rows of the series."""
    newest = F.max(F.struct("fecha", "tendencia", TARGET, "lag_1", "lag_2"))
    scaled = scaling(rows).withColumn("y_media", F.avg(TARGET).over(whole_series()))
    ends = scaled.groupBy(KEY).agg(
        F.first("media").alias("media"), F.first("escala").alias("escala"),
        F.first("y_media").alias("intercepto"), newest.alias("u"))
    return ends.select(
        KEY, "intercepto", "media", "escala",
        F.array(*[F.lit(0.01 * (i + 1)) for i in range(WIDTH)]).alias("coef"),
        F.col("u.fecha").alias("ultima"), F.col("u.tendencia").alias("tendencia_fin"),
        F.col(f"u.{TARGET}").alias("h1"), F.col("u.lag_1").alias("h2"),
        F.col("u.lag_2").alias("h3"))


def _residuals(rows: DataFrame) -> DataFrame:
    """How far each model is from solving its normal equations, as a yes or no."""
    models = m.fit_models(rows)
    error = F.expr(" + ".join(
        ["ventas - intercepto"]
        + [f"- (cast({c} as double) - media[{i}]) / escala[{i}] * coef[{i}]"
           for i, c in enumerate(FEATURES)]).replace("+ -", "-"))
    joined = rows.join(models.select(KEY, "n", "alpha", "intercepto", "coef", "media", "escala"),
                       KEY).withColumn("e", error)
    slopes = [
        F.abs(F.expr(f"sum((cast({c} as double) - media[{i}]) / escala[{i}] * e)"
                     f" - first(alpha) * first(coef[{i}])"))
        for i, c in enumerate(FEATURES)
    ]
    return joined.groupBy(KEY, "n").agg(
        (F.greatest(*slopes, F.abs(F.sum("e"))) < 1e-6).alias("resuelto"))


def _job(s, d):
    """The whole training through its one entry point."""
    return rounded(train(clean(s, d)).forecast, "ventas_reales", "ventas_predichas", digits=4)


def _too_short(s, d):
    return train(clean(s, d), ["id_producto", "Country"], min_days=1).too_short


def _skipped(s, d):
    return train(clean(s, d), ["id_producto", "Country"], min_days=1).skipped


def _pair_prepared(s, d) -> DataFrame:
    """Series of every product and country: many have too few months to search an alpha."""
    return prepared_series(demand_series(clean(s, d), ["id_producto", "Country"], 1))


QUERIES = {
    "cv_folds": lambda s, d: m.cv_folds(country_prepared(s, d)),
    "ridge_gram": lambda s, d: _gram(prepared(s, d)),
    "alpha_selected": lambda s, d: _alphas(m.fit_models(prepared(s, d))),
    "alpha_selected_by_country": lambda s, d: _alphas(m.fit_models(country_prepared(s, d))),
    "ridge_coefficients": lambda s, d: _coefficients(m.fit_models(prepared(s, d))),
    "ridge_coefficients_by_country": lambda s, d: _coefficients(
        m.fit_models(country_prepared(s, d))),
    "ridge_fit_check": lambda s, d: _residuals(country_prepared(s, d)),
    "backtest_rows": lambda s, d: _pairs(prepared(s, d)),
    "backtest_metrics": lambda s, d: _metrics(prepared(s, d)),
    "backtest_metrics_by_country": lambda s, d: _metrics(country_prepared(s, d)),
    "recursive_forecast_fixed_coef": lambda s, d: rounded(
        fc.recursive_steps(_fixed_models(country_prepared(s, d))), "prediccion"),
    "forecast_next_year": _job,
    "forecast_next_year_by_country": lambda s, d: _forecast(m.fit_models(country_prepared(s, d))),
    "incomplete_forecasts": lambda s, d: fc.incomplete_forecasts(
        fc.forecast_next_year(m.fit_models(country_prepared(s, d)))),
    "short_series": _too_short,
    "skipped_series": _skipped,
    "alpha_selected_short": lambda s, d: _alphas(m.fit_models(_pair_prepared(s, d))),
}

# --- SQL ----------------------------------------------------------------------

_LIST = ", ".join(FEATURES)
_STEP_FEATURES = """[h1, h2, h3, (h1 + h2 + h3) / 3,
        sqrt(((h1 - (h1 + h2 + h3) / 3) ** 2 + (h2 - (h1 + h2 + h3) / 3) ** 2
            + (h3 - (h1 + h2 + h3) / 3) ** 2) / 2),
        h1 - h2, month(sig), quarter(sig), t + 1,
        sin(2 * pi() * month(sig) / 12.0), cos(2 * pi() * month(sig) / 12.0)]"""


def _fit_ctes(rows: str) -> tuple[tuple[str, str], ...]:
    """Scaler, folds, and one solved system per series, fold and alpha.

    ``rows`` selects series_key, fila, n, ventas and the features of the rows to fit. Fold
    4 is the fit on all of them.
    """
    grid = ", ".join(f"({a})" for a in ALPHA_GRID)
    return (
        ("fitrows", rows),
        ("long", f"""
    SELECT series_key, fila, n, ventas AS y, unnest(range(1, 12)) AS j,
        unnest([CAST(c AS DOUBLE) FOR c IN [{_LIST}]]) AS v FROM fitrows"""),
        ("scaler", """
    SELECT series_key, j, avg(v) AS media, coalesce(nullif(stddev_pop(v), 0), 1) AS escala
    FROM long GROUP BY ALL"""),
        ("z", """
    SELECT long.series_key, fila, n, y, long.j, (v - media) / escala AS x
    FROM long JOIN scaler ON long.series_key = scaler.series_key AND long.j = scaler.j"""),
        ("folds", """
    SELECT series_key, n, k, CASE WHEN k = 4 THEN n ELSE n - (4 - k) * (n // 5) END AS hasta,
        n - (3 - k) * (n // 5) AS prueba
    FROM (SELECT DISTINCT series_key, n FROM fitrows), (SELECT unnest(range(0, 5)) AS k)
    WHERE k = 4 OR n >= 6"""),
        ("centre", """
    SELECT z.series_key, k, j, avg(x) AS mx, avg(y) AS my
    FROM z JOIN folds ON z.series_key = folds.series_key AND fila < hasta GROUP BY ALL"""),
        ("cz", """
    SELECT z.series_key, centre.k, fila, z.j, x - mx AS x, y - my AS y
    FROM z JOIN folds ON z.series_key = folds.series_key AND fila < hasta
    JOIN centre ON z.series_key = centre.series_key AND z.j = centre.j AND folds.k = centre.k"""),
        ("gram", """
    SELECT a.series_key, a.k, a.j AS i, b.j AS j, sum(a.x * b.x) AS g
    FROM cz a JOIN cz b ON a.series_key = b.series_key AND a.k = b.k AND a.fila = b.fila
    GROUP BY ALL"""),
        ("rhs", "SELECT series_key, k, j AS i, sum(x * y) AS c FROM cz GROUP BY ALL"),
        ("alphas", f"SELECT CAST(alpha AS DOUBLE) AS alpha FROM (VALUES {grid}) a(alpha)"),
        ("matrix_rows", """
    SELECT gram.series_key, gram.k, gram.i, alpha, list_append(
        list(g + CASE WHEN gram.i = j THEN alpha ELSE 0 END ORDER BY j), max(c)) AS fila
    FROM gram JOIN rhs ON gram.series_key = rhs.series_key AND gram.k = rhs.k AND gram.i = rhs.i
    CROSS JOIN alphas GROUP BY gram.series_key, gram.k, gram.i, alpha"""),
        ("elim", """
    SELECT series_key, k, alpha, 1 AS p, list(fila ORDER BY i) AS m
    FROM matrix_rows GROUP BY series_key, k, alpha
    UNION ALL
    SELECT series_key, k, alpha, p + 1, list_transform(range(1, 12), lambda i:
        CASE WHEN i = p THEN list_transform(m[p], lambda v: v / m[p][p])
        ELSE list_transform(range(1, 13), lambda j: m[i][j] - m[i][p] * m[p][j] / m[p][p]) END)
    FROM elim WHERE p <= 11"""),
        ("coefs", """
    SELECT series_key, k, alpha, list_transform(m, lambda f: f[12]) AS w FROM elim WHERE p = 12"""),
        ("solved", """
    SELECT coefs.series_key, coefs.k, alpha, any_value(w) AS w,
        any_value(my) - sum(w[j] * mx) AS b
    FROM coefs JOIN centre ON coefs.series_key = centre.series_key AND coefs.k = centre.k
    GROUP BY coefs.series_key, coefs.k, alpha"""),
        ("tested", """
    SELECT z.series_key, solved.k, alpha, fila, any_value(y) - any_value(b) - sum(x * w[j]) AS e
    FROM z JOIN folds ON z.series_key = folds.series_key AND fila >= hasta AND fila < prueba
    JOIN solved ON solved.series_key = z.series_key AND solved.k = folds.k
    WHERE folds.k < 4 GROUP BY z.series_key, solved.k, alpha, fila"""),
        ("scores", """
    SELECT series_key, alpha, avg(rmse) AS cv_rmse FROM (
        SELECT series_key, k, alpha, sqrt(avg(e * e)) AS rmse FROM tested GROUP BY ALL)
    GROUP BY ALL"""),
        ("chosen", f"""
    SELECT DISTINCT fitrows.series_key, CAST(n AS BIGINT) AS n,
        CASE WHEN n < 6 THEN {FALLBACK_ALPHA} ELSE s.alpha END AS alpha, cv_rmse
    FROM fitrows LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY cv_rmse, alpha) AS puesto
        FROM scores) s ON s.series_key = fitrows.series_key AND puesto = 1"""),
        ("model", """
    SELECT chosen.series_key, n, chosen.alpha, cv_rmse, w, b FROM chosen
    JOIN solved ON solved.series_key = chosen.series_key AND solved.alpha = chosen.alpha AND k = 4"""),
    )


_ALL_ROWS = "SELECT * FROM placed"
_TRAIN_ROWS = """
    SELECT * EXCLUDE (n), CAST(n - greatest(1, round_even(n * 0.2, 0)) AS INTEGER) AS n
    FROM placed WHERE fila < n - greatest(1, round_even(n * 0.2, 0))"""

_BACKTEST = (
    ("pairs", f"""
    SELECT t.series_key, fecha, model.alpha, exp(ventas) - 1 AS ventas_reales,
        exp(greatest(0, b + list_sum(list_transform(range(1, 12), lambda i:
            ([CAST(c AS DOUBLE) FOR c IN [{_LIST}]][i] - ms[i]) / es[i] * w[i])))) - 1
            AS ventas_predichas
    FROM (SELECT * FROM placed WHERE fila >= n - greatest(1, round_even(n * 0.2, 0))) t
    JOIN model ON model.series_key = t.series_key
    JOIN scales ON scales.series_key = t.series_key"""),
    ("metrics", """
    SELECT series_key, count(*) AS n_test,
        sqrt(avg((ventas_reales - ventas_predichas) ** 2)) AS rmse,
        avg(abs(ventas_reales - ventas_predichas)) AS mae,
        1 - sum((ventas_reales - ventas_predichas) ** 2) / (var_pop(ventas_reales) * count(*))
            AS r2
    FROM pairs GROUP BY series_key"""),
)

_SCALES = ("scales", """
    SELECT series_key, list(media ORDER BY j) AS ms, list(escala ORDER BY j) AS es
    FROM scaler GROUP BY series_key""")


def _steps(model: str) -> tuple[tuple[str, str], ...]:
    return (
        ("ends", """
    SELECT series_key, fecha AS ultima, tendencia, ventas, lag_1, lag_2
    FROM placed WHERE fila = n - 1"""),
        ("steps", f"""
    SELECT series_key, ultima, ultima AS fecha, tendencia AS t, ventas AS h1, lag_1 AS h2,
        lag_2 AS h3 FROM ends
    UNION ALL
    SELECT series_key, ultima, sig, t + 1, greatest(0, b + list_sum(list_transform(
            range(1, 12), lambda i: (f[i] - ms[i]) / es[i] * w[i]))), h1, h2
    FROM (
        SELECT n.*, {_STEP_FEATURES} AS f, w, b, ms, es
        FROM (SELECT *, CAST(fecha + INTERVAL 1 MONTH AS DATE) AS sig FROM steps) n
        JOIN {model} mo ON mo.series_key = n.series_key
        JOIN scales sc ON sc.series_key = n.series_key
    ) WHERE sig <= make_date(year(ultima) + 1, 12, 1)"""),
    )


_FORECAST = f"""
    SELECT series_key, fecha, {r_sql('exp(h1) - 1', 4)} AS ventas_reales,
        {r_sql('exp(h1) - 1', 4)} AS ventas_predichas
    FROM steps WHERE year(fecha) = year(ultima) + 1"""

_METRICS = f"""
    SELECT series_key, n_test, {r_sql('rmse', 4)} AS rmse, {r_sql('mae', 4)} AS mae,
        {r_sql('r2', 4)} AS r2, r2 > 0.99 AS sospechoso FROM metrics"""

_ALPHA = f"SELECT series_key, n, alpha, {r_sql('cv_rmse')} AS cv_rmse FROM chosen"

_COEFFICIENTS = f"""
    SELECT model.series_key, {r_sql('b')} AS intercepto, CAST(j - 1 AS INTEGER) AS i,
        {r_sql('w[j]')} AS coef, {r_sql('media')} AS media, {r_sql('escala')} AS escala
    FROM model JOIN scaler ON scaler.series_key = model.series_key"""

_PAIR = "id_producto || '|' || \"Country\""
_FIT = (*PREPARED, *_fit_ctes(_ALL_ROWS))
_COUNTRY_FIT = (*COUNTRY_PREPARED, *_fit_ctes(_ALL_ROWS))
_TRAIN = (*PREPARED, *_fit_ctes(_TRAIN_ROWS), _SCALES, *_BACKTEST)
_COUNTRY_TRAIN = (*COUNTRY_PREPARED, *_fit_ctes(_TRAIN_ROWS), _SCALES, *_BACKTEST)

# The stored forecast of the whole job: ridge months spread over the products by their units.
RIDGE_PLAN = sql((*STORED, *[c for c in (*_FIT, _SCALES, *_steps("model")) if c not in STORED],
                  ("ahead", """
    SELECT fecha, exp(h1) - 1 AS v FROM steps WHERE year(fecha) = year(ultima) + 1"""),
                  ("parts", """
    SELECT id_producto, CAST(sum(unidades_vendidas) AS DOUBLE)
        / (SELECT CAST(sum(unidades_vendidas) AS DOUBLE) FROM ventas) AS cuota
    FROM ventas GROUP BY id_producto
    UNION ALL SELECT NULL, 1.0""")), """
    SELECT id_producto, fecha AS fecha_prediccion,
        CAST(round_even(v * cuota, 0) AS BIGINT) AS unidades_predichas,
        CAST(round_even(v * cuota, 0) AS BIGINT) AS unidades_vendidas, TRUE AS con_clave
    FROM ahead CROSS JOIN parts""", recursive=True)

ORACLES = {
    "cv_folds": sql(COUNTRY_PREPARED, """
        SELECT series_key, n, CAST(k AS INTEGER) AS pliegue,
            CAST(n - (4 - k) * (n // 5) AS BIGINT) AS n_train, CAST(n // 5 AS BIGINT) AS n_test
        FROM (SELECT DISTINCT series_key, n FROM placed), (SELECT unnest(range(0, 4)) AS k)
        WHERE n >= 6"""),
    "ridge_gram": sql((*PREPARED, *_fit_ctes(_ALL_ROWS)[:4]), f"""
        SELECT series_key, CAST(bloque AS INTEGER) AS bloque, CAST(i AS INTEGER) AS i,
            CAST(j AS INTEGER) AS j, {r_sql('sum(xi * xj)')} AS suma
        FROM (SELECT a.series_key, a.j - 1 AS i, b.j - 1 AS j, a.x AS xi, b.x AS xj,
                CASE WHEN a.n < 6 OR a.fila < a.n - 4 * (a.n // 5) THEN 0
                    ELSE (a.fila - (a.n - 4 * (a.n // 5))) // (a.n // 5) + 1 END AS bloque
              FROM z a JOIN z b ON a.series_key = b.series_key AND a.fila = b.fila AND a.j <= b.j)
        GROUP BY series_key, bloque, i, j"""),
    "alpha_selected": sql(_FIT, _ALPHA, recursive=True),
    "alpha_selected_by_country": sql(_COUNTRY_FIT, _ALPHA, recursive=True),
    "ridge_coefficients": sql(_FIT, _COEFFICIENTS, recursive=True),
    "ridge_coefficients_by_country": sql(_COUNTRY_FIT, _COEFFICIENTS, recursive=True),
    "ridge_fit_check": sql(COUNTRY_PREPARED, """
        SELECT DISTINCT series_key, CAST(n AS BIGINT) AS n, TRUE AS resuelto FROM placed"""),
    "backtest_rows": sql(_TRAIN, f"""
        SELECT series_key, fecha, alpha, {r_sql('ventas_reales', 4)} AS ventas_reales,
            {r_sql('ventas_predichas', 4)} AS ventas_predichas FROM pairs""", recursive=True),
    "backtest_metrics": sql(_TRAIN, _METRICS, recursive=True),
    "backtest_metrics_by_country": sql(_COUNTRY_TRAIN, _METRICS, recursive=True),
    "recursive_forecast_fixed_coef": sql(
        (*COUNTRY_PREPARED, *_fit_ctes(_ALL_ROWS)[:3], _SCALES,
         ("fixed", """
    SELECT series_key, avg(ventas) AS b, [0.01 * i FOR i IN range(1, 12)] AS w
    FROM placed GROUP BY series_key"""), *_steps("fixed")), f"""
        SELECT series_key, CAST(year(ultima) AS INTEGER) AS ultimo_ano, fecha,
            {r_sql('h1')} AS prediccion FROM steps WHERE fecha > ultima""", recursive=True),
    "forecast_next_year": sql((*_FIT, _SCALES, *_steps("model")), _FORECAST, recursive=True),
    "forecast_next_year_by_country": sql((*_COUNTRY_FIT, _SCALES, *_steps("model")), _FORECAST,
                                         recursive=True),
    "incomplete_forecasts": sql((*_COUNTRY_FIT, _SCALES, *_steps("model")), """
        SELECT series_key, count(*) AS meses FROM steps WHERE year(fecha) = year(ultima) + 1
        GROUP BY series_key HAVING count(*) <> 12""", recursive=True),
    "short_series": sql((*LINES, *monthly_ctes(_PAIR, 1)), """
        SELECT series_key, count(*) AS meses FROM covered
        GROUP BY series_key HAVING count(*) <= 3"""),
    "skipped_series": sql((*LINES, *monthly_ctes(_PAIR, 1)), """
        SELECT series_key, count(*) AS meses,
            CASE WHEN count(*) <= 3 THEN 'sin modelo' ELSE 'sin backtest' END AS motivo
        FROM covered GROUP BY series_key HAVING count(*) <= 4"""),
    "alpha_selected_short": sql((*LINES, *monthly_ctes(_PAIR, 1), *PREPARED_STEPS,
                                 *_fit_ctes(_ALL_ROWS)), _ALPHA, recursive=True),
}
