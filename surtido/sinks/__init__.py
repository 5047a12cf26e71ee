"""Writers of the clean set, the stored tables, the forecast and the model."""

from surtido.sinks.files import (
    write_clean, write_days, write_forecast_csv, write_metrics, write_model, write_series,
    write_valid,
)
from surtido.sinks.keys import dense_key
from surtido.sinks.tables import (
    append_forecasts, append_sales, clear_tables, insert_ignore, missing_products, sales_key,
    write_jdbc,
)

__all__ = [
    "append_forecasts", "append_sales", "clear_tables", "dense_key", "insert_ignore",
    "missing_products", "sales_key", "write_clean", "write_days", "write_forecast_csv", "write_jdbc", "write_metrics",
    "write_model", "write_series", "write_valid",
]
