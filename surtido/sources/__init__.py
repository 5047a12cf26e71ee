"""Readers: invoice files, workbooks, stored tables."""

from surtido.sources.files import load_dataset, split_unparseable, typed, validate_columns
from surtido.sources.tables import (
    read_audit, read_clean, read_metrics, read_model, read_recent_sales, read_stored,
)

__all__ = [
    "load_dataset", "read_audit", "read_clean", "read_metrics", "read_model", "read_recent_sales",
    "read_stored", "split_unparseable", "typed", "validate_columns",
]
