"""Ridge regression per series, tuned by time-ordered folds.

Spark sums the moments (products of the scaled features and the target) per series and
block of rows. A training fold is a run of leading blocks, so running sums over at most
five blocks give every fold without copying a row. Python then gets one row per series and
solves all folds and alphas of a whole Arrow batch at once; it never sees a data row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.constants import (
    ALPHA_GRID, CV_SPLITS, FALLBACK_ALPHA, FEATURES, MIN_ROWS_FOR_SEARCH, SUSPECT_R2, TARGET,
)
from surtido.functions import clip, r2_score
from surtido.operators.features import scaled_features, time_split, with_position
from surtido.operators.series import KEY, whole_series
from surtido.session import send_to_workers

send_to_workers(__name__)

WIDTH = len(FEATURES)
PAIRS = [(i, j) for i in range(WIDTH) for j in range(i, WIDTH)]


def with_blocks(rows: DataFrame, min_rows: int = MIN_ROWS_FOR_SEARCH) -> DataFrame:
    """Number the blocks of the time-ordered folds.

    With blocks of ``n div 5`` rows, fold k trains on blocks 0..k and tests on block k+1;
    block 0 also takes the remainder. A series below ``min_rows`` is one block.
    """
    if min_rows <= CV_SPLITS:
        raise ValueError(f"a search needs at least {CV_SPLITS + 1} rows")
    size = F.floor(F.col("n") / (CV_SPLITS + 1))
    head = F.col("n") - CV_SPLITS * size
    block = F.when(
        (F.col("n") >= min_rows) & (F.col("fila") >= head),
        F.floor((F.col("fila") - head) / size) + 1,
    ).otherwise(0)
    return rows.withColumn("bloque", block.cast("int"))


def cv_folds(rows: DataFrame) -> DataFrame:
    """Row ranges of the folds: ``series_key, n, pliegue, n_train, n_test``."""
    blocks = with_blocks(with_position(rows)).groupBy(KEY, "n", "bloque").agg(
        F.count(F.lit(1)).alias("n_test"), F.min("fila").alias("n_train"))
    return blocks.filter(F.col("bloque") > 0).select(
        KEY, "n", (F.col("bloque") - 1).alias("pliegue"),
        F.col("n_train").cast("bigint").alias("n_train"), "n_test")


def _moments() -> Column:
    """Sums of x·x (upper triangle), x·y, x, then y, y·y and the row count."""
    sums = [f"sum(x[{i}] * x[{j}])" for i, j in PAIRS]
    sums += [f"sum(x[{i}] * y)" for i in range(WIDTH)]
    sums += [f"sum(x[{i}])" for i in range(WIDTH)]
    sums += ["sum(y)", "sum(y * y)", "cast(count(1) as double)"]
    return F.expr(f"array({', '.join(sums)})")


def moments(rows: DataFrame, min_rows: int = MIN_ROWS_FOR_SEARCH) -> DataFrame:
    """Moments per series and block, of the scaled features and the centred target.

    Centring by the series mean keeps the sums small; the intercept is free, so it changes
    no coefficient.
    """
    placed = rows if "fila" in rows.columns else with_position(rows)
    scaled = with_blocks(scaled_features(placed), min_rows).withColumn(
        "y_media", F.avg(TARGET).over(whole_series())
    ).withColumn("y", F.col(TARGET) - F.col("y_media"))
    end = F.struct(F.col("fecha").alias("ultima"), F.col("tendencia").alias("tendencia_fin"),
                   F.col(TARGET).alias("h1"), F.col("lag_1").alias("h2"),
                   F.col("lag_2").alias("h3"))
    return scaled.groupBy(KEY, "bloque").agg(
        _moments().alias("sumas"),
        F.first("media").alias("media"), F.first("escala").alias("escala"),
        F.first("y_media").alias("y_media"), F.max(end).alias("fin"),
    )


def _unpack(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Moment arrays (..., P) to matrix, x·y, x, y, y·y and count."""
    lead = sums.shape[:-1]
    gram = np.empty((*lead, WIDTH, WIDTH))
    for position, (i, j) in enumerate(PAIRS):
        gram[..., i, j] = gram[..., j, i] = sums[..., position]
    at = len(PAIRS)
    xy, x = sums[..., at:at + WIDTH], sums[..., at + WIDTH:at + 2 * WIDTH]
    y, yy, n = (sums[..., at + 2 * WIDTH + k] for k in range(3))
    return gram, xy, x, y, yy, n


def _fit(sums: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and intercept; the intercept is not penalised."""
    gram, xy, x, y, _, n = _unpack(sums)
    n = n[..., None]
    centre = x / n
    spread = gram - n[..., None] * centre[..., :, None] * centre[..., None, :]
    lean = xy - centre * y[..., None]
    penalty = alpha[..., None, None] * np.eye(WIDTH)
    coef = np.linalg.solve(spread + penalty, lean[..., None])[..., 0]
    return coef, y / n[..., 0] - (coef * centre).sum(-1)


def _squared_error(sums: np.ndarray, coef: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    gram, xy, x, y, yy, n = _unpack(sums)
    fitted = np.einsum("...i,...ij,...j->...", coef, gram, coef)
    cross = yy - 2 * (coef * xy).sum(-1) - 2 * intercept * y
    return np.maximum(cross + fitted + 2 * intercept * (coef * x).sum(-1) + n * intercept**2, 0.0)


# Series solved at once: bounds the memory of a Python worker (36 matrices per series).
SERIES_AT_ONCE = 1000


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), SERIES_AT_ONCE):
            yield batch.iloc[start:start + SERIES_AT_ONCE].reset_index(drop=True)


def _solve_batches(batches: Iterator[pd.DataFrame], min_rows: int,
                   fallback: float) -> Iterator[pd.DataFrame]:
    grid = np.array(ALPHA_GRID)
    for batch in _pieces(batches):
        per_block = np.array([
            [block if block is not None else np.zeros(len(blocks[0])) for block in blocks]
            for blocks in batch["bloques"]
        ], dtype=float)
        upto = per_block.cumsum(axis=1)
        total = upto[:, -1]
        count = total[:, -1]
        alpha = np.full(len(batch), float(fallback))
        cv_rmse = np.full(len(batch), np.nan)
        searched = count >= min_rows
        if searched.any():
            # axes: series, fold, alpha
            train = upto[searched][:, :CV_SPLITS, None, :]
            test = per_block[searched][:, 1:, None, :]
            shape = (*train.shape[:2], len(grid))
            coef, intercept = _fit(np.broadcast_to(train, (*shape, train.shape[-1])),
                                   np.broadcast_to(grid, shape))
            error = _squared_error(test, coef, intercept)
            score = np.sqrt(error / test[..., -1]).mean(axis=1)
            best = score.argmin(axis=1)
            alpha[searched] = grid[best]
            cv_rmse[searched] = score[np.arange(len(best)), best]
        coef, intercept = _fit(total, alpha)
        yield pd.DataFrame({
            KEY: batch[KEY],
            "n": count.astype("int64"),
            "alpha": alpha,
            "cv_rmse": [None if np.isnan(v) else v for v in cv_rmse],
            "buscada": searched,
            "intercepto": intercept + batch["y_media"].to_numpy(),
            "coef": list(coef),
            "media": batch["media"],
            "escala": batch["escala"],
            **{name: batch[name] for name in STATE},
        })


# Where a series ends: its last month, that month's trend index, its newest log values.
STATE = ("ultima", "tendencia_fin", "h1", "h2", "h3")
MODEL = (
    f"{KEY} string, n bigint, alpha double, cv_rmse double, buscada boolean, "
    "intercepto double, "
    "coef array<double>, media array<double>, escala array<double>, "
    "ultima date, tendencia_fin int, h1 double, h2 double, h3 double"
)


def fit_models(rows: DataFrame, min_rows: int = MIN_ROWS_FOR_SEARCH,
               fallback: float = FALLBACK_ALPHA) -> DataFrame:
    """One tuned model per series, with its scaler and the state the series ends in.

    The alpha with the lowest mean RMSE over the folds wins, the first one on ties. A series
    below ``min_rows`` rows has no folds: it takes ``fallback``, and ``buscada`` says so.
    """
    by_series = moments(rows, min_rows).groupBy(KEY).agg(
        F.array(*[F.max(F.when(F.col("bloque") == b, F.col("sumas")))
                  for b in range(CV_SPLITS + 1)]).alias("bloques"),
        F.first("media").alias("media"), F.first("escala").alias("escala"),
        F.first("y_media").alias("y_media"), F.max("fin").alias("fin"),
    )
    return by_series.select("*", "fin.*").drop("fin").mapInPandas(
        lambda batches: _solve_batches(batches, min_rows, fallback), MODEL)


def predict(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Predicted log value of every row by the model of its series, not below 0."""
    model = models.select(KEY, "alpha", "intercepto", "coef", "media", "escala")
    return _predicted(rows.join(model, KEY))


def _predicted(rows: DataFrame) -> DataFrame:
    """``prediccion`` of rows that carry their model."""
    terms = [f"(cast({name} as double) - media[{i}]) / escala[{i}] * coef[{i}]"
             for i, name in enumerate(FEATURES)]
    total = F.expr(f"intercepto + {' + '.join(terms)}")
    return rows.withColumn("prediccion", clip(total, low=0.0)).drop(
        "intercepto", "coef", "media", "escala")


def backtest_rows(prepared: DataFrame) -> DataFrame:
    """Actual and predicted units of the test rows, by models fitted on the train rows.

    The test rows of a series, at most a fifth of its months, travel as one list and meet
    the model in a group by the series, so nothing is joined. Series without a train row
    have no model and no rows here; ``Training.skipped`` names them.
    """
    split = time_split(prepared)
    train = split.filter(F.col("parte") == "train").drop("fila", "n", "parte")
    row = F.struct("fecha", TARGET, *FEATURES)
    tests = split.filter(F.col("parte") == "test").groupBy(KEY).agg(
        F.collect_list(row).alias("filas"))
    model = F.struct("alpha", "intercepto", "coef", "media", "escala")
    parts = fit_models(train).select(KEY, model.alias("modelo")).unionByName(
        tests, allowMissingColumns=True)
    together = parts.groupBy(KEY).agg(
        F.first("modelo", ignorenulls=True).alias("modelo"),
        F.first("filas", ignorenulls=True).alias("filas"))
    rows = together.filter(F.col("modelo").isNotNull()).select(
        KEY, "modelo.*", F.explode("filas").alias("f")).select(
        KEY, "alpha", "intercepto", "coef", "media", "escala", "f.*")
    return _predicted(rows).select(
        KEY, "fecha", "alpha",
        F.expm1(TARGET).alias("ventas_reales"),
        F.expm1("prediccion").alias("ventas_predichas"),
    )


def error_metrics(pairs: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """RMSE, MAE and R2 of ``ventas_predichas`` against ``ventas_reales``."""
    actual = F.col("ventas_reales")
    miss = actual - F.col("ventas_predichas")
    n = F.count(F.lit(1))
    spread = F.var_pop(actual) * n
    r2 = r2_score(n, F.sum(miss * miss), spread)
    return pairs.groupBy(*keys).agg(
        n.alias("n_test"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        r2.alias("r2"),
    )


def backtest_metrics(prepared: DataFrame) -> DataFrame:
    """Error metrics per series; a very high R2 points at leakage and is flagged."""
    metrics = error_metrics(backtest_rows(prepared))
    return metrics.withColumn("sospechoso", F.coalesce(F.col("r2") > SUSPECT_R2, F.lit(False)))


def confidence(metrics: DataFrame) -> DataFrame:
    """R2 bounded to [0, 1]; null where a series has no score."""
    return metrics.select(KEY, clip(F.col("r2"), 0.0, 1.0).alias("confianza"))
