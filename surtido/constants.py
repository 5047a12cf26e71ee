"""Fixed values shared by the operators, and the defaults of their options."""

# --- Fixed values: names and texts that stored results must carry -------------

REQUIRED_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
)

INTERNAL_NAMES = {
    "InvoiceNo": "id_venta_original",
    "StockCode": "id_producto",
    "Description": "nombre",
    "Quantity": "unidades_vendidas",
    "InvoiceDate": "fecha_venta",
    "UnitPrice": "precio_unitario",
}

CANCELLED_PREFIX = "C"
MISSING_DESCRIPTION = "Sin descripción"
MISSING_CODE = "nan"
DEFAULT_CATEGORY = "Sin categoría"
NO_CONFIDENCE_TEXT = "Sin datos"

FEATURES = (
    "lag_1",
    "lag_2",
    "lag_3",
    "media_3",
    "std_3",
    "diff_1",
    "mes",
    "trimestre",
    "tendencia",
    "mes_sin",
    "mes_cos",
)
TARGET = "ventas"

# Characters that stripping a text removes from its ends: all Unicode white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts a CSV reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Invoice date texts accepted besides ISO ones, tried in this order (month before day).
DATE_FORMATS = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "yyyy/M/d H:mm:ss",
    "yyyy/M/d H:mm",
    "yyyy/M/d",
    "d-MMM-yyyy H:mm:ss",
    "d-MMM-yyyy H:mm",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "MMM d, yyyy",
)

# --- Fixed values: numbers ----------------------------------------------------

MIN_ACTIVE_DAYS = 5          # distinct sale days a product needs in the last month
RECENT_DAYS = 30             # window of the recent-sales query
PRODUCT_LIST_LIMIT = 500     # products on one page of the selector
LABEL_NAME_LENGTH = 40       # characters of the name shown in the selector
MIN_MONTH_COVERAGE = 25      # sale days a month needs to enter a series
FENCE_WIDTH = 3.0            # outlier fences, in interquartile ranges
ROLLING_ROWS = 3             # history rows behind the rolling features
TEST_RATIO = 0.20            # share of the newest rows kept for the backtest
CV_SPLITS = 4                # time-ordered folds of the alpha search
MIN_ROWS_FOR_SEARCH = 6      # shorter series take FALLBACK_ALPHA
ALPHA_GRID = (0.01, 0.1, 1.0, 3.0, 10.0, 30.0, 100.0, 300.0, 1000.0)
FALLBACK_ALPHA = 10.0
SUSPECT_R2 = 0.99            # a higher backtest R2 is reported as suspect
INSERT_BATCH = 5000          # rows per statement of a database sink

# --- Names of this library ----------------------------------------------------

GLOBAL_SERIES = "global"
