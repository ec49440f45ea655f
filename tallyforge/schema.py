"""Columns, defaults, labels and thresholds of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ------------------------------------------------- fixed values: columns

REQUIRED_COLUMNS = ["date", "price"]

# Default of an optional column that a file does not carry at all.  None means
# "unknown" (never zero): sums skip it and ratios stay NULL.
OPTIONAL_DEFAULTS = {
    "customer": "Unknown",
    "region": "Unknown",
    "discount": 0.0,
    "profit": None,
    "product": "Unknown",
    "category": "Unknown",
    "quantity": 1.0,
    "sales_target": None,
}

# The columns that make two line items "the same row".  order_id is not one of
# them: it may be synthetic.
BUSINESS_COLUMNS = [
    "date", "customer", "product", "category", "region",
    "quantity", "price", "discount", "profit", "sales_target",
]

TEXT_COLUMNS = ["customer", "product", "category", "region"]
NUMBER_COLUMNS = ["quantity", "price", "discount", "profit", "sales_target"]

# A typed line item as the sources hand it to the quality rules.
LINE_ITEM = T.StructType(
    [T.StructField("date", T.TimestampNTZType())]
    + [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in NUMBER_COLUMNS]
    + [
        T.StructField("order_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("missing_optional", T.ArrayType(T.StringType())),
    ]
)

# ------------------------------------------------- fixed values: file headers

HEADER_ALIASES = {
    "product name": "product",
    "item name": "product",
    "service provided": "product",
    "service": "product",
    "service name": "product",
    "unit price": "price",
    "order id": "order_id",
    "order number": "order_id",
    "order no": "order_id",
    "invoice id": "order_id",
    "invoice number": "order_id",
    "sales target": "sales_target",
    "target": "sales_target",
}

UNDERSCORE_HEADERS = {
    "order_date": "date",
    "customer_name": "customer",
    "product": "product",
    "product_category": "category",
    "region": "region",
    "units_sold": "quantity",
    "unit_price": "price",
    "discount_pct": "discount",
    "profit": "profit",
}

LINE_TOTAL_HEADERS = {
    "order date": "date",
    "customer name": "customer",
    "product name": "product",
    "category": "category",
    "region": "region",
    "quantity": "quantity",
    "discount": "discount",
    "profit": "profit",
    "sales": "sales",
}

# Cells read as missing in delimited files.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ----------------------------------------------- fixed values: quality rules

DATE_HALT_FRACTION = 0.05

BAD_DATE = "skipped:bad_date"
BAD_QTY_PRICE = "skipped:invalid_qty_price"
NO_REGION = "flagged:invalid_region"
NO_CATEGORY = "flagged:invalid_category"
NO_CUSTOMER = "flagged:invalid_customer"
DISCOUNT_CLAMPED = "clamped:discount"
LOSS_ROW = "flagged:negative_profit"
DUPLICATE = "flagged:duplicate"

LABEL_TEXT = {
    NO_REGION: "missing region",
    NO_CATEGORY: "missing category",
    DISCOUNT_CLAMPED: "discount was out of the valid 0-100% range and was corrected",
    LOSS_ROW: "negative profit on this row",
    DUPLICATE: "duplicate row",
    NO_CUSTOMER: "missing customer",
}

# Why a file without required columns is rejected: one of them, or several.
MISSING_COLUMNS = (
    "'{file}' can't be used — it's missing the column: {missing}. Fix: open the file, add a header named exactly "
    "'{first}' with the right values in each row, then run the report again. Required columns: {required}. "
    "Optional columns (the report still works without them): {optional}.",
    "'{file}' can't be used — it's missing the columns: {missing}. Fix: open the file, add a header named exactly "
    "'{first}' (and: {others}) with the right values in each row, then run the report again. Required columns: "
    "{required}. Optional columns (the report still works without them): {optional}.",
)

# %1$d is the share of rows in percent and %2$s the file.
TOO_MANY_BAD_DATES = (
    "'%2$s' can't be used — %1$d%% of its rows don't have a valid date, so this file was skipped entirely. Fix: open "
    "the file and check the 'date' column — make sure it's named exactly 'date' and every row has a real date "
    "(e.g. 2026-07-15), then run the report again."
)

# Check name -> (level, message); %1$d is the count and %2$s the file.
ISSUE_MESSAGES = {
    "bad_date": ("skip", "Skipped %1$d row(s) in %2$s — the 'date' column was blank or unreadable for those rows."),
    "invalid_qty_price": ("skip", "Skipped %1$d row(s) in %2$s — quantity was zero/negative or price was negative."),
    "invalid_region": ("warn", "%1$d row(s) have a blank/missing region in %2$s."),
    "invalid_category": ("warn", "%1$d row(s) have a blank/missing category in %2$s."),
    "invalid_customer": ("warn", "%1$d row(s) have a blank/missing customer in %2$s."),
    "discount": ("warn", "Corrected %1$d discount value(s) in %2$s that were outside the valid 0-100%% range."),
    "negative_profit": ("warn", "%1$d row(s) have negative profit in %2$s."),
    "duplicate": ("warn", "Found %1$d duplicate row(s) within %2$s — not removed."),
    "order_id_reuse": (
        "warn",
        "%1$d Order_ID(s) reused across different orders in %2$s -- likely a typo (e.g. a repeated ID that should be "
        "the next number in sequence). Rows were kept since their order details differ, but the ID(s) need fixing at "
        "the source.",
    ),
    "cross_file_duplicate": (
        "warn",
        "Found %1$d row(s) duplicated across multiple files — check for the same export saved "
        "under more than one filename.",
    ),
}

# ------------------------------------------------ fixed values: review rules

DECLINE_WARNING = -15.0
DECLINE_CRITICAL = -30.0
LOW_MARGIN = 0.10
HIGH_DISCOUNT = 0.15
WEAK_REGION_SHARE = 0.2
UNDERPERFORMER_QUANTILE = 0.1

# Upper bound (inclusive) -> label, in report order.
DISCOUNT_BANDS = [
    (0.0, "No discount"),
    (0.05, "Above 0% through 5%"),
    (0.10, "Above 5% through 10%"),
    (0.20, "Above 10% through 20%"),
    (None, "Above 20%"),
]

KPI_NAMES = [
    "gross_sales", "discount_amount", "net_sales", "total_profit", "overall_margin", "num_orders",
    "units_sold", "avg_order_value", "avg_selling_price", "discount_rate", "profit_per_order",
    "distinct_customers", "sales_target", "target_achievement", "sales_growth", "profit_growth",
    "negative_profit_orders", "discounted_orders",
]
