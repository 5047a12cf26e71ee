"""A selection of the registered queries against their SQL twins on the smallest tables.

``python tests/compare.py`` runs all of them on any scale.
"""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SELECTION = (
    "clean_lines", "clean_audit", "split_counts", "kpis", "catalog_top_price_all",
    "monthly_units_filled", "feature_matrix", "ridge_gram", "alpha_selected",
    "ridge_coefficients", "backtest_metrics", "forecast_next_year", "allocate_forecast",
    "constraint_violations", "surrogate_key", "csv_roundtrip", "xlsx_scan", "clean_stream",
)

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_twin_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@needs_tables
@pytest.mark.parametrize("name", SELECTION)
def test_query_equals_its_twin(spark, name):
    result, _, _ = compare(spark, connect(FOLDER), FOLDER, name)
    assert result.startswith("ok")


@needs_tables
def test_entry_gives_twelve_months(spark):
    assert entry(spark).count() == 12
