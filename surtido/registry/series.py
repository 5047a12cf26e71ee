"""Demand series and model features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.constants import FEATURES, TARGET
from surtido.functions import months_to_end_of_next_year
from surtido.operators import features as f
from surtido.operators import series as o
from surtido.registry.base import (
    COUNTRY_DAYS, COUNTRY_KEYS, COUNTRY_SERIES, SERIES, clean, r_sql, rounded, sql,
)


def serie(s, d) -> DataFrame:
    return o.demand_series(clean(s, d))


def country_serie(s, d) -> DataFrame:
    return o.demand_series(clean(s, d), COUNTRY_KEYS, COUNTRY_DAYS)


def logs(s, d) -> DataFrame:
    return o.log_series(o.cap_outliers(serie(s, d)))


def prepared(s, d) -> DataFrame:
    return f.prepared_series(serie(s, d))


def country_prepared(s, d) -> DataFrame:
    return f.prepared_series(country_serie(s, d))


REAL = ("lag_1", "lag_2", "lag_3", "media_3", "std_3", "diff_1", "mes_sin", "mes_cos", TARGET)


def _calendar(df: DataFrame) -> DataFrame:
    calendar = df.withColumns(f.calendar_columns(F.col("fecha")))
    return rounded(calendar, "mes_sin", "mes_cos").drop(TARGET)


def _lags(df: DataFrame) -> DataFrame:
    return rounded(df.withColumns(f.lag_columns()), "lag_1", "lag_2", "lag_3", "diff_1", TARGET)


def _rolling(df: DataFrame) -> DataFrame:
    return rounded(df.withColumns(f.rolling_columns()), "media_3", "std_3", TARGET)


def _scaled(df: DataFrame) -> DataFrame:
    """One column per scaled feature."""
    scaled = f.scaled_features(df)
    return rounded(
        scaled.select("series_key", "fecha",
                      *[F.col("x")[i].alias(f"x_{name}") for i, name in enumerate(FEATURES)]),
        *[f"x_{name}" for name in FEATURES])


def _split(df: DataFrame) -> DataFrame:
    return f.time_split(df).select("series_key", "fecha", "fila", "n", "parte")


QUERIES = {
    "daily_units": lambda s, d: o.daily_units(clean(s, d)),
    "daily_units_by_country": lambda s, d: o.daily_units(clean(s, d), COUNTRY_KEYS),
    "month_coverage": lambda s, d: o.monthly_units(clean(s, d)),
    "monthly_units_filled": lambda s, d: o.fill_months(o.monthly_units(clean(s, d))),
    "monthly_units_filled_by_product": lambda s, d: o.fill_months(
        o.monthly_units(clean(s, d), ["id_producto"])),
    "monthly_covered": lambda s, d: o.covered_months(o.monthly_units(clean(s, d))),
    "series_report": lambda s, d: o.series_report(country_serie(s, d)),
    "iqr_fences": lambda s, d: o.iqr_fences(serie(s, d)),
    "iqr_fences_by_country": lambda s, d: o.iqr_fences(country_serie(s, d), width=0.5),
    "outlier_flags": lambda s, d: o.outlier_flags(country_serie(s, d), width=0.5),
    "capped_series": lambda s, d: o.cap_outliers(country_serie(s, d), width=0.5),
    "log_series": lambda s, d: rounded(logs(s, d), TARGET),
    "series_skew": lambda s, d: rounded(o.skew_report(country_serie(s, d)),
                                        "asimetria", "asimetria_log"),
    "lag_features": lambda s, d: _lags(logs(s, d)),
    "rolling_features": lambda s, d: _rolling(logs(s, d)),
    "calendar_features": lambda s, d: _calendar(serie(s, d)),
    "feature_matrix": lambda s, d: rounded(prepared(s, d), *REAL),
    "feature_matrix_by_country": lambda s, d: rounded(country_prepared(s, d), *REAL),
    "time_split": lambda s, d: _split(country_prepared(s, d)),
    "scaled_features": lambda s, d: _scaled(prepared(s, d)),
    "scaled_features_by_country": lambda s, d: _scaled(country_prepared(s, d)),
    "future_months": lambda s, d: o.series_report(country_serie(s, d)).select(
        "series_key", F.explode(months_to_end_of_next_year(F.col("ultima"))).alias("fecha")),
}

LOGS = (
    ("fences", """
    SELECT series_key, quantile_cont(ventas, 0.25) AS q1, quantile_cont(ventas, 0.75) AS q3
    FROM serie GROUP BY series_key"""),
    ("logs", """
    SELECT series_key, fecha,
        ln(1 + greatest(q1 - 3.0 * (q3 - q1), least(q3 + 3.0 * (q3 - q1), ventas))) AS ventas
    FROM serie JOIN fences USING (series_key)"""),
)

FEATURE_ROWS = (
    ("windows", """
    SELECT series_key, fecha, ventas,
        lag(ventas, 1) OVER w AS lag_1, lag(ventas, 2) OVER w AS lag_2,
        lag(ventas, 3) OVER w AS lag_3,
        CASE WHEN count(*) OVER p = 3 THEN avg(ventas) OVER p END AS media_3,
        CASE WHEN count(*) OVER p = 3 THEN stddev_samp(ventas) OVER p END AS std_3,
        lag(ventas, 1) OVER w - lag(ventas, 2) OVER w AS diff_1,
        CAST(month(fecha) AS INTEGER) AS mes, CAST(quarter(fecha) AS INTEGER) AS trimestre,
        CAST(row_number() OVER w - 1 AS INTEGER) AS tendencia,
        sin(2 * pi() * month(fecha) / 12.0) AS mes_sin,
        cos(2 * pi() * month(fecha) / 12.0) AS mes_cos
    FROM logs
    WINDOW w AS (PARTITION BY series_key ORDER BY fecha),
        p AS (PARTITION BY series_key ORDER BY fecha ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""),
    ("features", "SELECT * FROM windows WHERE lag_3 IS NOT NULL"),
    ("placed", """
    SELECT *, CAST(row_number() OVER (PARTITION BY series_key ORDER BY fecha) - 1 AS INTEGER)
            AS fila,
        CAST(count(*) OVER (PARTITION BY series_key) AS INTEGER) AS n
    FROM features"""),
)

PREPARED_STEPS = (*LOGS, *FEATURE_ROWS)
PREPARED = (*SERIES, *PREPARED_STEPS)
COUNTRY_PREPARED = (*COUNTRY_SERIES, *PREPARED_STEPS)

_MATRIX = (
    "SELECT series_key, fecha, mes, trimestre, tendencia, "
    + ", ".join(f"{r_sql(c)} AS {c}" for c in REAL) + " FROM features"
)


def _scaled_sql(ctes) -> str:
    columns = ", ".join(
        f"{r_sql(f'({c} - avg({c}) OVER s) / coalesce(nullif(stddev_pop({c}) OVER s, 0), 1)')}"
        f" AS x_{c}" for c in FEATURES)
    return sql(ctes, f"""
        SELECT series_key, fecha, {columns} FROM features
        WINDOW s AS (PARTITION BY series_key)""")


_OUTSIDE = """
    SELECT serie.*, q1, q3, q1 - 0.5 * (q3 - q1) AS limite_bajo,
        q3 + 0.5 * (q3 - q1) AS limite_alto,
        ventas < q1 - 0.5 * (q3 - q1) OR ventas > q3 + 0.5 * (q3 - q1) AS atipico
    FROM serie JOIN fences USING (series_key)"""

_FILL = """
    SELECT g.series_key, CAST(g.fecha AS DATE) AS fecha, coalesce(m.ventas, 0) AS ventas,
        coalesce(m.dias, 0) AS dias
    FROM (SELECT series_key, unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 MONTH))
              AS fecha FROM monthly GROUP BY series_key) g
    LEFT JOIN monthly m ON m.series_key = g.series_key AND m.fecha = g.fecha"""


def _product_series():
    from surtido.registry.base import LINES, monthly_ctes
    return (*LINES, *monthly_ctes("id_producto"))


ORACLES = {
    "daily_units": sql(SERIES, "SELECT * FROM daily"),
    "daily_units_by_country": sql(COUNTRY_SERIES, "SELECT * FROM daily"),
    "month_coverage": sql(SERIES, "SELECT * FROM monthly"),
    "monthly_units_filled": sql(SERIES, _FILL),
    "monthly_units_filled_by_product": sql(_product_series(), _FILL),
    "monthly_covered": sql(SERIES, "SELECT * FROM covered"),
    "series_report": sql(COUNTRY_SERIES, """
        SELECT series_key, count(*) AS meses, min(fecha) AS primera, max(fecha) AS ultima
        FROM serie GROUP BY series_key"""),
    "iqr_fences": sql((*SERIES, *LOGS), """
        SELECT series_key, q1, q3, q1 - 3.0 * (q3 - q1) AS limite_bajo,
            q3 + 3.0 * (q3 - q1) AS limite_alto,
            count(*) FILTER (ventas < q1 - 3.0 * (q3 - q1) OR ventas > q3 + 3.0 * (q3 - q1))
                AS detectados
        FROM serie JOIN fences USING (series_key) GROUP BY series_key, q1, q3"""),
    "iqr_fences_by_country": sql((*COUNTRY_SERIES, *LOGS, ("outside", _OUTSIDE)), """
        SELECT series_key, q1, q3, limite_bajo, limite_alto,
            count(*) FILTER (atipico) AS detectados
        FROM outside GROUP BY ALL"""),
    "outlier_flags": sql((*COUNTRY_SERIES, *LOGS), _OUTSIDE),
    "capped_series": sql((*COUNTRY_SERIES, *LOGS, ("outside", _OUTSIDE)), """
        SELECT series_key, fecha, greatest(limite_bajo, least(limite_alto, ventas)) AS ventas
        FROM outside"""),
    "log_series": sql((*SERIES, *LOGS),
                      f"SELECT series_key, fecha, {r_sql('ventas')} AS ventas FROM logs"),
    "series_skew": sql(COUNTRY_SERIES, f"""
        SELECT series_key, {r_sql('skewness(ventas)')} AS asimetria,
            {r_sql('skewness(ln(1 + ventas))')} AS asimetria_log
        FROM serie GROUP BY series_key"""),
    "lag_features": sql(PREPARED, "SELECT series_key, fecha, " + ", ".join(
        f"{r_sql(c)} AS {c}" for c in ("lag_1", "lag_2", "lag_3", "diff_1", "ventas"))
        + " FROM windows"),
    "rolling_features": sql(PREPARED, "SELECT series_key, fecha, " + ", ".join(
        f"{r_sql(c)} AS {c}" for c in ("media_3", "std_3", "ventas")) + " FROM windows"),
    "calendar_features": sql(PREPARED, "SELECT series_key, fecha, mes, trimestre, "
                             f"{r_sql('mes_sin')} AS mes_sin, {r_sql('mes_cos')} AS mes_cos "
                             "FROM windows"),
    "feature_matrix": sql(PREPARED, _MATRIX),
    "feature_matrix_by_country": sql(COUNTRY_PREPARED, _MATRIX),
    "time_split": sql(COUNTRY_PREPARED, """
        SELECT series_key, fecha, fila, n,
            CASE WHEN fila >= n - greatest(1, CAST(round_even(n * 0.2, 0) AS INTEGER))
                THEN 'test' ELSE 'train' END AS parte
        FROM placed"""),
    "scaled_features": _scaled_sql(PREPARED),
    "scaled_features_by_country": _scaled_sql(COUNTRY_PREPARED),
    "future_months": sql(COUNTRY_SERIES, """
        SELECT series_key, CAST(unnest(generate_series(ultima + INTERVAL 1 MONTH,
            make_date(year(ultima) + 1, 12, 1), INTERVAL 1 MONTH)) AS DATE) AS fecha
        FROM (SELECT series_key, max(fecha) AS ultima FROM serie GROUP BY series_key)"""),
}
